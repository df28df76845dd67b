"""Token counts by offset-mapped attribution (operator 1).

Every document is encoded once, whole.  The byte span of each token follows
from the byte lengths of its ids (byte-level BPE covers the text without gaps),
is mapped to a span of characters, and is joined to the sections' character
intervals.  A token that crosses a boundary is allocated by one rule.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import bound_batches

RULES = ("first", "last", "most", "share")
_ENCODERS: dict = {}


def _encoder(path: str, pattern: str):
    """tiktoken encoding and the byte length of each id, loaded once per worker."""
    if path not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            lengths[i] = len(token)
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _ENCODERS[path]


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) of the tokens of ``text``.

    Tokens that split one character's bytes all span that character.
    """
    encoder, lengths = _encoder(path, pattern)
    ends = np.cumsum(lengths[encoder.encode_to_numpy(text)])
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) == len(text):
        return starts, ends
    char = np.cumsum((raw & 0xC0) != 0x80) - 1        # character that holds each byte
    return char[starts], char[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing) per section; section i is ``bounds[i]:bounds[i + 1]``, sections tile the text.

    first / last: the section of the token's first / last character; most: the
    section that holds most of its characters (ties: the earlier); share: split
    in proportion to characters.  ``crossing`` counts the tokens that touch the
    section and another one.
    """
    n = len(bounds) - 1
    a = np.searchsorted(bounds, starts, "right") - 1
    b = np.searchsorted(bounds, ends - 1, "right") - 1
    tokens = np.zeros(n)
    crossing = np.zeros(n, np.int64)
    within = a == b
    tokens += np.bincount(a[within], minlength=n)
    for i in np.flatnonzero(~within):
        s = np.arange(a[i], b[i] + 1)
        part = np.minimum(bounds[s + 1], ends[i]) - np.maximum(bounds[s], starts[i])
        s, part = s[part > 0], part[part > 0]
        crossing[s] += 1
        if rule == "first":
            tokens[s[0]] += 1
        elif rule == "last":
            tokens[s[-1]] += 1
        elif rule == "most":
            tokens[s[np.argmax(part)]] += 1
        else:
            tokens[s] += part / part.sum()
    return tokens, crossing


def section_token_counts(df: DataFrame, id_col: str, text_cols: list[str], path: str, pattern: str,
                         rule: str = "most", separator: str = "\n", line_sections: bool = True) -> DataFrame:
    """Tokens of every section of every row's document.

    The document is the row's ``text_cols`` joined by ``separator`` (which ends
    the field before it) and is encoded once.  Sections are the fields, and with
    ``line_sections`` the lines of each field (a line holds its line feed).

    Returns (id_col, field string, section int from 0 within the document,
    char_start long, char_end long, tokens double, crossing long).  A null field
    is an empty one; an empty field gives one section without characters and
    tokens.  Each row counts for itself: repeated rows and null ids are kept as
    they come.  Other columns of ``df`` are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches):
        for batch in batches:
            columns = [batch.column(1 + i) for i in range(len(text_cols))]
            row, field, section, lo, hi, tokens, crossing = ([] for _ in range(7))
            for r in range(batch.num_rows):
                parts = [c[r].as_py() or "" for c in columns]
                text = separator.join(parts)
                at, cuts, names, empty = 0, [], [], []
                for i, part in enumerate(parts):
                    stop = at + len(part) + (len(separator) if i + 1 < len(parts) else 0)
                    inner = np.flatnonzero(np.frombuffer(part.encode("utf-32-le"), np.uint32) == 10) + 1 \
                        if line_sections and "\n" in part else np.zeros(0, np.int64)
                    begins = [at, *(at + x for x in inner.tolist() if x < len(part))]
                    cuts += begins
                    names += [i] * len(begins)
                    empty += [stop == at] * len(begins)
                    at = stop
                bounds = np.array([*cuts, at], np.int64)
                starts, ends = token_spans(text, path, pattern) if text else (bounds[:0], bounds[:0])
                # an empty field has no characters, so no token can start in it
                live = np.flatnonzero(~np.array(empty, bool))
                got, crossed = np.zeros(len(cuts)), np.zeros(len(cuts), np.int64)
                if len(live):
                    got[live], crossed[live] = attribute(starts, ends, np.append(bounds[live], at), rule)
                row += [r] * len(cuts)
                field += names
                section += range(len(cuts))
                lo.append(bounds[:-1])
                hi.append(bounds[1:])
                tokens.append(got)
                crossing.append(crossed)
            if not row:
                continue
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array(text_cols).take(pa.array(field)), pa.array(section, pa.int32()),
                pa.array(np.concatenate(lo), pa.int64()), pa.array(np.concatenate(hi), pa.int64()),
                pa.array(np.concatenate(tokens)), pa.array(np.concatenate(crossing), pa.int64()),
            ], names=[id_col, "field", "section", "char_start", "char_end", "tokens", "crossing"])

    bound_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, *text_cols).mapInArrow(
        run, f"`{id_col}` {kind}, field string, section int, char_start long, char_end long, tokens double, crossing long")
