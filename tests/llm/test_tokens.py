"""Token files, token counts and packing against the tokenizers library itself."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from tidemark import session
from tidemark.llm import encoder, packing, token_counts, token_files
from tidemark.llm.queries import BYTE_BPE, WORD_BPE

ODD = [
    "", " ", "\n", "a", "  a  b\n\n c\t d", "foo \n bar  baz ", "<|endoftext|> hi<|endoftext|>x <|endoftext|>", "a\x1cb c", "x\x1d. y",
    "İstanbul ΣΑΣ ΟΔΟΣ’s don't I'll", "x　 y z  ", "trail  \n", "é ́a", "\xa0 a \xa0b", "a., b.. c, d. e ,f don.t x.",
    "x. y.\n z.", "ﬁ. ª. é. ", "ͅ a. ͅ,", "ß, ǅ, Ω.", "###,, $$. %%%", "1 22, 333. 4a.", "🙂🙂 🙂.", "Word,\nWord. Word,", "\t\t \n x",
]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_pieces_are_encoded_as_the_library_does(path):
    plain, ours = Tokenizer.from_file(path), encoder.Encoder(encoder.load(path))
    rng = random.Random(1)
    texts = ODD + [prose(rng, 60) for _ in range(20)] + ["".join(rng.choices("ab .,\n\té<|>'s1#", k=40)) for _ in range(400)]
    assert ours.split is not None
    for some in (texts, texts[::-1]):  # the second time from memory
        for text, raw in zip(some, ours.encode(some), strict=True):
            assert np.frombuffer(raw, ours.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_letters_that_normalize_to_a_mark_before_punctuation(path):
    plain, ours = Tokenizer.from_file(path), encoder.Encoder(encoder.load(path))
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    texts = ["BELEDİYESİ, bir", "xİ. y", "হয়, কিন্তু", "é. ü, ñ. x"] + [f"x{c}{m} y" for c in letters for m in ".,"]
    want = [x.ids for x in plain.encode_batch_fast(texts, add_special_tokens=False)]
    got = [np.frombuffer(raw, ours.dtype).tolist() for raw in ours.encode(texts)]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_letters_in_any_case_are_encoded_as_the_library_does():
    plain, ours = Tokenizer.from_file(WORD_BPE), encoder.Encoder(encoder.load(WORD_BPE))
    letters = [chr(c) for c in range(0x41, 0x300) if chr(c).isalpha()]
    texts = [f"{a}b{c} {c}{a}!! {c.lower()}x.\n{c.upper()} {c}'S, {c}" for a, c in zip(letters, letters[7:] + letters[:7], strict=True)]
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts += [f"{c}{m} {c.upper()}{m}x. Y{m}, X" for c in "abhijktwyABHIJKTWY" for m in marks] + [f"A{chr(c)}B.{chr(c)} C!{chr(c)}" for c in range(0x2000, 0x2070)]
    texts += ["a<|ENDOFTEXT|>B. c", "A <|EndOfText|>, <|endoftext|>X!! Y.", "a'S. it'LL!' x'.", "A.'B ('C)! don'T?\n", "\u212aelvin \u212bX. K"]
    want = [x.ids for x in plain.encode_batch_fast(texts, add_special_tokens=False)]
    got = [np.frombuffer(raw, ours.dtype).tolist() for raw in ours.encode(texts)]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_forms_of_a_word_are_encoded_once():
    """Case and the marks after a word do not make it a new piece, and a word of letters takes no whole-text call."""
    ours = encoder.Encoder(encoder.load(WORD_BPE))
    calls = []
    ours._spaced = lambda words, prefix: calls.append(words) or encoder.Encoder._spaced(ours, words, prefix)
    ours.encode(["River river! RIVER,\nriver?! River.", "Élan élan; ÉLAN... (élan)"])
    assert sorted(ours.alone.ids) == sorted(["river", "élan", "(élan", ")", "!", ",", "?!", ".", ";", "..."])
    assert not [w for words in calls for w in words if w.isalpha()]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_text(texts):
    for path in (WORD_BPE, BYTE_BPE):
        ours = encoder.encoder(encoder.load(path))
        for text, raw in zip(texts, ours.encode(texts), strict=True):
            assert np.frombuffer(raw, ours.dtype).tolist() == ours.tokenizer.encode(text, add_special_tokens=False).ids


def test_full_memory_gives_the_same(monkeypatch):
    ours = encoder.Encoder(encoder.load(WORD_BPE))
    ours.alone.limit = 20
    rng = random.Random(2)
    for _ in range(20):
        text = prose(rng, 15)
        assert np.frombuffer(ours.encode([text])[0], ours.dtype).tolist() == ours.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=0, max_size=700))
def test_boundaries_round_trip(sizes):
    starts = np.cumsum([0, *sizes])[: len(sizes)].astype(np.int64)
    held = token_files.Boundaries.encode(starts, int(sum(sizes)))
    assert held.all().tolist() == starts.tolist()
    assert [held.select(i) for i in range(len(sizes))] == starts.tolist()
    assert len(held.low) + len(held.high) <= len(sizes) * (3 + max(1, int(sum(sizes)) // max(1, len(sizes))).bit_length()) / 8 + 2


def test_file_gives_single_documents():
    texts = [np.arange(n, dtype="<u2").tobytes() for n in (3, 0, 500, 1)]
    held = token_files.TokenFile.from_bytes(token_files.TokenFile.to_bytes(4, 0, 70, [5, 6, 7, 8], texts, np.dtype("<u2")))
    assert (held.part, held.start_in_part, held.doc_ids.tolist()) == (4, 70, [5, 6, 7, 8])
    assert [held.document(i).tobytes() for i in range(4)] == texts


def test_rows_of_a_file_come_through_its_samples():
    import pandas as pd

    texts = [np.arange(k % 7, dtype="<u2").tobytes() for k in range(600)]
    raw = token_files.TokenFile.to_bytes(0, 0, 0, list(range(600)), texts, np.dtype("<u2"))
    good = pd.concat(token_files._reader(iter([pd.DataFrame({"content": [raw]})])))
    assert good["n_tokens"].tolist() == [k % 7 for k in range(600)]
    assert good["ids_crc32"].tolist() == [crc(range(k % 7)) for k in range(600)]
    at = token_files.HEADER.size + 8 * 600 + 4  # the second sample, of documents 256 to 511
    wrong = raw[:at] + (int.from_bytes(raw[at : at + 4], "little") + 40).to_bytes(4, "little") + raw[at + 4 :]
    bad = pd.concat(token_files._reader(iter([pd.DataFrame({"content": [wrong]})])))
    differ = (bad["start_in_part"] != good["start_in_part"]).to_numpy()
    assert differ[256:512].all() and not differ[:256].any() and not differ[512:].any()


SOME = [(4, "Some words, here."), (2, None), (9, ""), (7, "x " * 5000), (1, "<|endoftext|> a"), (3, "Some words, here."), (3, "other"), (None, "no id"), (4, "Some words, here.")]


def expected(rows, path, end):
    plain = Tokenizer.from_file(path)
    return [(i, plain.encode(t or "", add_special_tokens=False).ids + [end] * (end is not None)) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("file_ids", [50, 4_000_000])
def test_token_files(docs, file_ids):
    got = token_files.token_files(docs(SOME), WORD_BPE, 2, file_ids).collect()
    want = sorted(expected(SOME, WORD_BPE, 2), key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    starts, at = [], 0
    for _, ids in want:
        starts.append(at)
        at += len(ids)
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == {(i, len(ids), crc(ids)) for i, ids in want}
    assert sorted(r.start for r in got) == starts
    by_start = sorted(got, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(by_start, by_start[1:], strict=False))
    assert [r.doc_id for r in by_start] == [i for i, _ in want]


def test_tokens_of_nothing(spark, docs):
    assert token_files.token_files(docs([]), WORD_BPE, 2).collect() == []
    assert token_counts.count_tokens(docs([]), WORD_BPE, session.shared_dir(spark, "cache")).collect() == []
    assert packing.pack(docs([]), BYTE_BPE, 0).collect() == []


def test_counts_and_cache(spark, docs, monkeypatch):
    path = session.shared_dir(spark, "cache")
    plain = Tokenizer.from_file(WORD_BPE)
    want = sorted((-1 if i is None else i, len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in SOME)
    for _ in range(2):
        got = token_counts.count_tokens(docs(SOME), WORD_BPE, path, limit=100).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 100) for r in got)
        # the second run encodes nothing anew
        assert token_counts.read_cache(spark, path).count() == len({t or "" for _, t in SOME})
    token_counts.count_tokens(docs([*SOME, (50, "new text")]), WORD_BPE, path).collect()
    assert token_counts.read_cache(spark, path).count() == len({t or "" for _, t in SOME}) + 1
    # what the cache says is used, and another vocabulary has counts of its own
    version = encoder.version(WORD_BPE, encoder.load(WORD_BPE))
    other = session.shared_dir(spark, "cache")
    spark.range(1).select(F.sha2(F.lit("new text"), 256).alias("digest"), F.lit(version).alias("tokenizer"), F.lit(77).cast("long").alias("n_tokens")).write.parquet(other)
    assert token_counts.count_tokens(docs([(1, "new text")]), WORD_BPE, other).first().n_tokens == 77
    assert token_counts.count_tokens(docs([(1, "new text")]), BYTE_BPE, other).first().n_tokens == 2


def test_sentencepiece_counts(spark, docs):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.count_tokens(docs(SOME[:5]), path, session.shared_dir(spark, "cache")).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(model.encode(t or "")) for i, t in SOME[:5]}


def check_packing(got, capacity, want):
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    whole = {}
    for r in got:
        whole.setdefault((r.doc_id, r.start, r.piece), []).append((r.length, r.ids_crc32))
    pieces = []
    for i, ids in want:
        head = len(ids) % capacity or capacity
        edges = [0, *range(head, len(ids) + 1, capacity)]
        pieces += [(i, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    assert sorted(map(repr, pieces)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    return len(used)


def test_packing(docs):
    got = packing.pack(docs(SOME), BYTE_BPE, 0, capacity=64).collect()
    check_packing(got, 64, expected(SOME, BYTE_BPE, 0))


def test_packing_many(docs):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(1, 60))) for i in range(300)] + [(i, None) for i in range(300, 450)]
    want = expected(rows, BYTE_BPE, 0)
    used = check_packing(packing.pack(docs(rows), BYTE_BPE, 0, capacity=128).collect(), 128, want)
    assert used <= 1.03 * sum(len(ids) for _, ids in want) / 128 + 1


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
def test_plan_places_every_piece_once(histogram):
    plan = packing.make_plan(histogram, 40)
    assert not plan.left.any()
    taken = {}
    space = [0] * plan.sequences
    for length, first, last, sequence, offset in plan.runs:
        taken.setdefault(length, []).append((first, last))
        for i in range(last - first):
            assert space[sequence + i] == offset
            space[sequence + i] += length
    assert all(0 < x <= 40 for x in space)
    for length, n in histogram.items():
        at = 0
        for first, last in sorted(taken[length]):
            assert first == at and last > first
            at = last
        assert at == n
    # best fit never leaves two sequences half empty
    assert sum(x <= 20 for x in space) <= 1


def test_exact_complements_come_first():
    plan = packing.make_plan({30: 2, 10: 1, 6: 1, 4: 1, 25: 1, 9: 1, 3: 1, 2: 1, 1: 1}, 40)
    assert plan.sequences == 3


def scanned(left, gap, held):
    """Whether one, two or three lengths fill the gap, by trying all."""
    free = left.copy()
    free[held] -= 1
    some = [x for x in range(1, len(left)) if free[x] > 0]
    parts = [(a,) for a in some] + [(a, b) for a in some for b in some if a >= b] + [(a, b, c) for a in some for b in some for c in some if a >= b >= c]
    return any(sum(p) == gap and all(free[x] >= p.count(x) for x in p) for p in parts)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 19), st.integers(1, 3), min_size=1, max_size=12), st.randoms())
def test_index_of_sums_misses_nothing_as_counts_fall(histogram, rng):
    left = np.zeros(21, np.int64)
    for length, n in histogram.items():
        left[length] = n
    sums = packing.Sums(left)
    while left.any():
        held = rng.choice(np.flatnonzero(left).tolist())
        for gap in range(1, 20):
            parts = sums.complement(gap, held)
            assert (parts is not None) == scanned(left, gap, held)
            assert parts is None or (sum(parts) == gap and all(left[x] >= (*parts, held).count(x) for x in (*parts, held)))
        left[rng.choice(np.flatnonzero(left).tolist())] -= 1


def test_exact_fills_of_a_plan_come_from_the_index(monkeypatch):
    seen = []
    complement = packing.Sums.complement

    def noted(self, gap, *held):
        parts = complement(self, gap, *held)
        seen.append(parts and (*held, *parts))
        return parts

    monkeypatch.setattr(packing.Sums, "complement", noted)
    rng = random.Random(3)
    plan = packing.make_plan({rng.randrange(1, 2048): rng.randrange(1, 9) for _ in range(900)}, 2048)
    found = [p for p in seen if p]
    assert found and all(sum(p) == 2048 and len(p) <= 4 for p in found)
    assert not plan.left.any()
