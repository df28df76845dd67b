"""cadenza — catalogue and listener analytics expressed as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` parametrised by column
names.  Work is declared with the DataFrame / SQL API so Catalyst prunes,
pushes down and plans it; nothing but small, size-bounded results (p x p
matrices, top-n label lists, rule configs) ever reaches the driver.
"""

__version__ = "0.1.0"
