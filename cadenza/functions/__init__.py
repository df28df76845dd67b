"""Column functions: standardisers (SCL-*), validation predicates (VAL-*),
rule presets (JOB-04/05) and deterministic ids / noise."""
