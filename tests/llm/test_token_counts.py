"""Token attribution against a direct count over the reference tokenizer's offsets."""

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cadenza.llm.token_counts import section_token_counts

PATH, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def brute(text, rule):
    """Per line of ``text``: tokens by rule, from the offsets of the other library's encoder."""
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    lines, at = [], 0
    for part in text.splitlines(keepends=True) if "\r" not in text else text.split("\n"):
        lines.append((at, at + len(part)))
        at += len(part)
    out = [0.0] * len(lines)
    raw = text.encode()
    pos = 0
    for piece in tok.encode(text, add_special_tokens=False).tokens:
        a, b = pos, pos + len(piece)          # one character of a byte-level token per byte
        pos = b
        c0, c1 = len(raw[:a].decode("utf8", "ignore")), len(raw[:b].decode("utf8", "ignore"))
        if raw[a] & 0xC0 == 0x80:
            c0 = len(raw[:a].decode("utf8", "ignore"))
        if b < len(raw) and raw[b] & 0xC0 == 0x80:
            c1 += 1                            # the character is not complete yet
        share = [max(0, min(e, c1) - max(s, c0)) for s, e in lines]
        hit = [i for i, x in enumerate(share) if x]
        if rule == "first":
            out[hit[0]] += 1
        elif rule == "last":
            out[hit[-1]] += 1
        elif rule == "most":
            out[int(np.argmax(share))] += 1
        else:
            for i in hit:
                out[i] += share[i] / sum(share)
    assert pos == len(raw)
    return out


TEXTS = ["one line", "a\nb\n\n  c", "é\U0001f600ü\nñandú \n \n\n\tx", "\n\n\n", "word " * 4000 + "\n" + "end\n", "x" * 30000]


@pytest.mark.parametrize("rule", ["first", "last", "most", "share"])
def test_lines_match_brute_force(spark, rule):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = section_token_counts(df, "doc_id", ["text"], PATH, PATTERN, rule).collect()
    for i, text in enumerate(TEXTS):
        got = [r.tokens for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.section)]
        assert np.allclose(got, brute(text, rule)), (rule, text[:20])


def test_fields_are_encoded_as_one_document(spark):
    df = spark.createDataFrame([(1, "title ", " body\nmore"), (2, None, ""), (None, "a", None)], "i long, t string, b string")
    rows = section_token_counts(df, "i", ["t", "b"], PATH, PATTERN, "share", line_sections=False).collect()
    by = {(r.i, r.field): r for r in rows}
    assert by[1, "t"].char_end == 7 and by[1, "b"].char_start == 7
    import tiktoken  # noqa: F401
    total = sum(brute("title \n body\nmore", "share"))
    assert np.isclose(by[1, "t"].tokens + by[1, "b"].tokens, total)
    assert by[2, "b"].tokens == 0 and by[2, "t"].tokens == 1       # the separator alone
    assert by[None, "t"].tokens + by[None, "b"].tokens == 2


def test_empty_table_nulls_repeats_and_extra_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string, tokens int")
    assert section_token_counts(none, "doc_id", ["text"], PATH, PATTERN).count() == 0
    df = spark.createDataFrame([(1, None, 7), (1, "", 7), (1, "a b", 7), (1, "a b", 7)], "doc_id long, text string, tokens int")
    rows = section_token_counts(df, "doc_id", ["text"], PATH, PATTERN).collect()
    assert sorted(r.tokens for r in rows) == [0, 0, 2, 2]
