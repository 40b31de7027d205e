"""Token counts against the library itself; spelling variants against all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import public_tokenizers
from sluiceway.llm import rank_merge, textscan, variants

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def merger():
    return rank_merge.PieceMerger(PIECES)


@pytest.mark.parametrize("name", ["odd", "real"])
def test_token_counts(request, spark, library, name):
    docs = request.getfixturevalue("odd") if name == "odd" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = Counter(tuple(r) for r in rank_merge.count_tokens(docs, PIECES).collect())
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        n = len(library.encode(r.text or ""))
        expected[r.doc_id, len((r.text or "").encode()), n, n > 4096] += 1
    assert got == expected


def test_token_counts_of_nothing(odd):
    assert rank_merge.count_tokens(odd.limit(0), PIECES).collect() == []


def test_symbols_of_random_texts(library, merger):
    rng = random.Random(4)
    letters = list("aabehnortxxx   \n\t▁.,<s>/0éñß漢😀")
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 80)))
        assert merger.ids(np.array([ord(c) for c in " " + text], dtype=np.uint32)).tolist() == library.encode(text)


def test_a_long_sequence_goes_the_same_way(library, merger, monkeypatch):
    text = "thethereandonethe" * 30
    chars = np.array([ord(c) for c in " " + text], dtype=np.uint32)
    alone = merger.ids(chars).tolist()
    monkeypatch.setattr(rank_merge, "LONG", 10_000)
    assert merger.ids(chars).tolist() == alone == library.encode(text)


def test_a_full_store_is_emptied(library, monkeypatch):
    monkeypatch.setattr(rank_merge, "UNITS", 3)
    counter = rank_merge.UnitCounter(PIECES)
    for text in ["one two three four", "five two six", "one seven"] * 2:
        _, data, offsets = next(textscan.slices(__import__("pyarrow").array([text])))
        assert counter.count(data, offsets).tolist() == [len(library.encode(text))]


def brute_words(rows, shortest=7, least=2):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(words):
    names = sorted(words)
    near = {w: [v for v in names if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in names}
    form = {}
    for w in names:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in names:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("block_words", [4096, 8])
def test_variants(spark, odd, block_words):
    rng = random.Random(7)
    rows = []
    for i in range(400):  # a family around few stems, with repeated letters and accents
        stem = rng.choice(["abababab", "aaaaaaaa", "straßenbau", "mississippi", "élévation", "abcdefg" * 12])
        word = list(stem)
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(word))
            word[at : at + rng.choice([0, 1])] = rng.choice(["a", "b", "é", "Z", ""])
        rows.append((i, " ".join(["".join(word)] * rng.choice([2, 3, 40, 900]))))
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string")).withColumns({"n": F.lit(1), "word": F.lit("x"), "key": F.lit(0)})
    words = brute_words(docs.select("doc_id", "text").collect())
    got = variants.variants(docs, block_words=block_words).collect()
    expected = brute_variants(words)
    assert {tuple(r) for r in got} == expected and len(got) == len(expected) > 150
    assert any(r.root != r.form for r in got if r.form is not None)


def test_variants_of_nothing(odd):
    assert variants.variants(odd.limit(0)).collect() == []


def test_a_group_larger_than_a_block_is_dealt_out(spark):
    words = spark.createDataFrame([("abcdef" + chr(97 + i) + chr(97 + j), 2) for i in range(26) for j in range(26)], "word string, n long")
    units = variants.in_blocks(words, 7, 50).groupBy("key", "low", "high").count().collect()
    assert max(r["count"] for r in units) < 150
    near = variants.near_words(words, block_words=50)
    assert near.count() == near.distinct().count() == 676 * 50


def test_crc_of_spans():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 4700, 200))
    ends = starts + rng.integers(0, 300, 200)
    state = rng.integers(0, 2**32, 200).astype(np.uint32)
    got = variants.crc_after(state, data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(starts, ends, state)]
    assert len(variants.crc_after(state[:0], data, starts[:0], ends[:0])) == 0
