"""Rolling hashes on texts made to collide: Thue-Morse strings."""
import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import textnp as T
from starmart.llm.jaccard_join import jaccard_components, shingle_sets
from starmart.llm.packing import encoder_of, packed
from starmart.llm.quality_rules import repetition_scores
from starmart.llm.queries import tokenizer_path
from starmart.llm.substring_dedup import span_dedup
from tests.llm.data import frame


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


PAIRS = [(thue_morse(n), thue_morse(n, "b", "a")) for n in (256, 1024, 2048, 4096)]


def spans(texts):
    data, offsets = T.utf8(pa.array(texts))
    return T.byte_spans(data, offsets[:-1], offsets[1:])


def test_spans_of_any_content_differ_and_equal_ones_agree():
    texts = [x for pair in PAIRS for x in pair] + ["", "a", "aa", "ab", "ba", "b" * 5000]
    assert len(set(spans(texts).tolist())) == len(texts)
    assert len(set(spans(["xyz", "xyz"]).tolist())) == 1
    data, offsets = T.utf8(pa.array(["abcabcabc"]))
    h = T.byte_spans(data, np.array([0, 3, 6, 1]), np.array([3, 6, 9, 4]))
    assert h[0] == h[1] == h[2] != h[3]


def test_hash_equals_the_polynomial_by_plain_arithmetic():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    starts = rng.integers(0, 400, 50)
    ends = starts + rng.integers(0, 100, 50)
    p = (1 << 31) - 1
    want = []
    for s, e in zip(starts.tolist(), ends.tolist()):
        parts = [[(int(v) >> k) & p for v in values[s:e]] for k in (0, 31)]
        one, two = (sum(v * pow(b, i, p) for i, v in enumerate(part)) % p for part, b in zip(parts, T._BASES))
        want.append(one << 31 | two)
    assert T.span_hashes(values, starts, ends).tolist() == want


@pytest.mark.parametrize("one,two", PAIRS)
def test_quality_rules(spark, one, two):
    filler = " ".join(f"w{i}" for i in range(40))
    (r,) = repetition_scores(frame(spark, [f"{filler}\n{one}\n{two}\n{one}"])).collect()
    assert r.n_dup_lines == 1
    words = " ".join([one, two] * 8)  # windows of eight words repeat, by parity
    turned = " ".join(f"{one if bin(i).count('1') & 1 else two}{i}" for i in range(64))
    got = repetition_scores(frame(spark, [words, turned])).orderBy("doc_id").collect()
    assert [g.n_repeat_words for g in got] == [16, 0]


def test_packing_gives_each_word_its_ids(spark):
    from tokenizers import Tokenizer
    import zlib
    plain = Tokenizer.from_file(tokenizer_path())
    texts = [x for pair in PAIRS for x in pair]
    got = {r.doc_id: r.ids_crc32 for r in packed(frame(spark, texts), tokenizer_path()).collect() if r.start == 0
           and r.length == r.doc_tokens}
    assert len(got) > 4
    for i, crc in got.items():
        ids = np.array([*plain.encode(texts[i], add_special_tokens=False).ids, 2], dtype="<u4")
        assert zlib.crc32(ids.tobytes()) == crc


def test_a_word_of_equal_hash_and_other_bytes_goes_to_the_library(monkeypatch):
    from starmart.llm import packing
    encoder = packing.WordEncoder(tokenizer_path())
    texts = pa.array(["alpha beta gamma", "delta alpha", "beta, omega 12"])
    want = [x.tolist() for x in encoder.encode(texts)]
    weak = packing.WordEncoder(tokenizer_path())
    monkeypatch.setattr(packing, "byte_spans", lambda d, s, e: (e - s).astype(np.uint64))
    assert [x.tolist() for x in weak.encode(texts)] == want
    assert [x.tolist() for x in weak.encode(texts)] == want


def test_jaccard_and_spans(spark):
    one, two = PAIRS[2]
    sets = list(shingle_sets(pa.array([one, two, f"{one} {two} a b c", f"{two} {one} a b c"])))
    assert len({tuple(s.tolist()) for s in sets}) == 4
    got = jaccard_components(frame(spark, [one, two, one])).orderBy("doc_id").collect()
    assert [r.component_id for r in got] == [0, 1, 0]
    rest = " ".join(f"x{i}" for i in range(30))
    texts = [f"{rest} {one}. {rest} {one}.", f"{rest} {two}. {rest} {two}."]
    kept = {r.doc_id: r.n_removed for r in span_dedup(frame(spark, texts)).collect()}
    assert kept[1] == 0
