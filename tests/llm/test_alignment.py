"""Cross-tokenizer alignment against both libraries and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from sluiceway.llm import alignment

RANKS, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of_char():
    """The usual byte-level letters: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def encoded():
    a, b = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    to_byte = byte_of_char()

    def of(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + text).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return [], []
        return list(zip(ids_a, map(len, bytes_a))), list(zip(ids_b, map(len, bytes_b)))

    return of


def brute(texts, encoded):
    docs, held = [], Counter()
    for text in texts:
        a, b = encoded(text or "")
        ends_a, ends_b = np.cumsum([n for _, n in a]).tolist(), np.cumsum([n for _, n in b]).tolist()
        links, groups, own_a, own_b, i, j = [], [], [], [], 0, 0
        while i < len(a):
            links.append((a[i][0], b[j][0]))
            own_a += [a[i][0]] * (not own_a or links[-2:-1] == [] or i != seen[0])
            own_b += [b[j][0]] * (not own_b or j != seen[1])
            seen = (i, j)
            if ends_a[i] == ends_b[j]:
                groups.append((own_a, own_b))
                own_a, own_b, i, j = [], [], i + 1, j + 1
            elif ends_a[i] < ends_b[j]:
                i += 1
            else:
                j += 1
        text_groups = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(text_groups.encode()).hexdigest() if a else ""))
        held.update(set(links))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(n, top.get(x, 0))
    return [(na, nb, g, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha) for na, nb, g, links, sha in docs]


@pytest.mark.parametrize("name,block_bytes", [("odd", 1 << 24), ("odd", 2000), ("real", 1 << 17)])
def test_alignment(request, spark, encoded, name, block_bytes):
    docs = request.getfixturevalue("odd") if name == "odd" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    expected = Counter((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows], encoded)))
    got = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in alignment.align(docs, RANKS, PIECES, block_bytes).collect())
    assert got == expected


def test_alignment_of_nothing(odd):
    assert alignment.align(odd.limit(0), RANKS, PIECES).collect() == []


def test_overlaps_equal_a_plain_loop():
    rng = np.random.default_rng(2)
    for n in [1, 5, 200, 999]:
        ends = np.arange(1, n + 1)
        a = np.union1d(rng.choice(ends, max(1, n // 3)), [n])
        b = np.union1d(rng.choice(ends, max(1, n // 2)), [n])
        expected, i, j, group = [], 0, 0, 0
        while i < len(a):
            expected.append((i, j, group))
            group += a[i] == b[j]
            i, j = i + (a[i] <= b[j]), j + (b[j] <= a[i])
        for step in (1, 3, 64):
            assert list(zip(*(x.tolist() for x in alignment.overlaps(a, b, step)))) == expected
    none = np.zeros(0, dtype=np.int64)
    assert [len(x) for x in alignment.overlaps(none, none)] == [0, 0, 0]


def test_packed_values_come_back():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 2**31, 5], dtype=np.int64)
    column = alignment.binaries(values, np.array([0, 0, 3, 9]))
    back, border = alignment.values_of(column)
    assert back.tolist() == values.tolist() and border.tolist() == [0, 0, 3, 9]
    assert alignment.values_of(column.slice(2, 1))[0].tolist() == values[3:].tolist()
