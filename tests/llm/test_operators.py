"""The training-data operators against brute force on small tables with nulls, empty texts, copies and clashing columns."""

import json
import math
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from sluiceway.llm import blocks, catalog, imatch, language_id, language_model, minhash, packing, quality, rendezvous, sparse_suffix, textscan, tiling, tool_calls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
ADDED = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
CLASHING = ["score", "block", "bucket", "kept", "text_key", "node", "key", "row", "part", "shard", "slot", "first", "n"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    base = " ".join(f"w{i}" for i in range(120))
    moved = " ".join(f"w{i}" for i in [*range(60, 120), *range(60)])
    rows = [
        (1, base, "en"), (2, base, "en"), (2, base, "en"), (3, moved, None), (4, base.upper(), "de"), (5, "", "en"), (6, None, "en"), (7, "one two", "fr"),
        (8, "one two", "fr"), (None, "no id here " * 30, "es"), (9, "x" * 300_000, "en"), (10, base.replace("w5 ", "v5 "), "en"), (11, "12 34 !!", None), (12, " \n\t ", "en"),
        (13, ("à la " + base + " é") * 40, "fr"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


def test_word_scan_equals_a_regular_expression(edge):
    texts = [r.text for r in edge.collect()]
    by_word = {}
    for at, data, offsets in textscan.slices(edge.toArrow()["text"], limit=1000):
        found = textscan.words(data, offsets)
        for d in range(found.docs):
            own = found.hash[found.first[d] : found.first[d + 1]].tolist()
            expected = words(texts[at + d])
            assert len(own) == len(expected)
            for h, w in zip(own, expected):
                assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def check_pieces(docs, pieces, length=1024):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter(tuple([r.doc_id, *model.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in docs.collect())
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    found = 0
    for doc, n in expected.items():
        ids = np.array(doc[1:], dtype="<u4")
        fitting = [p for p in by_doc[doc[0]] if p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())]
        assert sum(p.length for p in fitting) >= n * len(ids)
        found += n * len(ids)
    assert sum(p.length for p in pieces) == found
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at and n > 0
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding / max(found, 1)


def test_packing(spark, edge, real, empty):
    check_pieces(edge, packing.pack(edge, VOCABULARY, added=ADDED).collect())
    assert check_pieces(real, packing.pack(real, VOCABULARY, partition_bytes=1 << 16, added=ADDED).collect()) < 0.02
    assert packing.pack(empty, VOCABULARY).collect() == []


def test_packing_has_the_tokenizers_ids_for_added_tokens(spark):
    token = "<|endoftext|>"
    texts = [token, f"a {token}", f"a  {token}  b", f"{token}{token} {token}\n", f"x{token}y<|endoftext", f" {token}", f"word \t {token} , 12{token}é", "<|endoftext| >", "plain"]
    texts += [f"{token} " * 400, "".join(f"w{i} {token}"[: 5 + i % 9] for i in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_pieces(docs, packing.pack(docs, VOCABULARY, added=ADDED).collect())
    assert ADDED == {token: 50256}


def test_packed_ids_are_those_of_the_texts(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(1, "one <|endoftext|> two " * 300), (2, None), (3, "drei")], "doc_id long, text string")
    ids = defaultdict(list)
    for r in packing.pack(docs, VOCABULARY, added=ADDED, with_ids=True).orderBy("doc_id", "start").collect():
        ids[r.doc_id] += r.ids
    assert ids == {r.doc_id: [*model.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}


def test_packing_cuts_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(30):
        at = [0, *np.cumsum(rng.integers(1, 6, 25)).tolist()]
        cost = [0, *rng.integers(0, 9, 25).tolist()]
        best = [0.0] + [math.inf] * 25
        for j in range(1, 26):
            best[j] = min(best[i] + 12 - (at[j] - at[i]) + cost[j] for i in range(j) if at[j] - at[i] <= 12)
        cuts = packing.best_cuts(at, cost, 12)
        assert sum(12 - (at[j] - at[i]) + cost[j] for i, j in zip(cuts, cuts[1:])) == best[25]


def test_quality(spark, edge, empty, real):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = quality.held_out_rule()
    weights = quality.train(docs, labels, ~held)
    rows = quality.score(docs, weights, held).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    out = quality.score(edge, weights, held).collect()
    assert len(out) == 15 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert quality.score(empty, quality.train(empty, labels, ~held), held).collect() == []


def brute_model(rows, train, mu):
    """(counts of words, weight of a word after a history of at most two words, failure arcs included)."""
    c, pairs, triples, texts = Counter(), Counter(), Counter(), 0
    for r in rows:
        if train(r.doc_id):
            t = [*words(r.text), None]
            c.update(t)
            pairs.update(zip(["^", *t], t))
            triples.update(zip(["^", *t], t, t[1:]))
            texts += 1
    total, kinds = sum(c.values()), len(c)

    def weight(history, w):
        if not history:
            return (c[w] + 0.1) / (total + 0.1 * (kinds + 1))
        left = pairs[history] if len(history) == 2 else texts if history == ("^",) else c[history[0]]
        arc = (triples if len(history) == 2 else pairs)[(*history, w)]
        return (arc + mu * weight(history[1:], w)) / (left + mu)

    return c, weight


def brute_scores(rows, train, mu):
    c, weight = brute_model(rows, train, mu)
    for r in rows:
        t = [*words(r.text), None]
        before = ["^", *t]
        score = sum(math.log10(weight(tuple(before[max(0, i - 1) : i + 1]), w)) for i, w in enumerate(t))
        yield r.doc_id, len(t), sum(c[w] > 0 for w in t), sum(c.values()), sum(math.log10(weight((), w)) for w in t), score


def test_weights_of_every_state_sum_to_one(real):
    c, weight = brute_model(real.select("doc_id", "text").collect(), lambda i: True, language_model.MU)
    some = sorted(w for w in c if w)[:: len(c) // 5]
    for history in [(), ("^",), ("^", some[0]), *[(w,) for w in some], *zip(some, some[1:]), ("not seen", some[1])]:
        assert sum(weight(history, w) for w in [*c, "not seen"]) == pytest.approx(1, rel=1e-9)


@pytest.mark.parametrize("name", ["edge", "real"])
def test_language_model(request, name):
    docs = request.getfixturevalue(name)
    got = language_model.score_texts(docs, blocks.crc_mod(F.col("doc_id"), 10) != 0, block_bytes=1 << 16).collect()
    train = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 != 0
    key = lambda x: (str(x[0]), x[1], round(x[5], 4))
    expected = sorted(brute_scores(docs.select("doc_id", "text").collect(), train, language_model.MU), key=key)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_language_model_of_nothing(empty):
    assert language_model.score_texts(empty, F.lit(True)).collect() == []


def test_fingerprints(edge, real, empty):
    terms = imatch.lexicon(real)
    out = imatch.compare_with_edits(real, terms).collect()
    texts = {r.doc_id: r.text for r in real.collect()}
    order = sorted(texts)
    import hashlib

    for r in out:
        text, following = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        q = len(text) // 4
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256((text[: len(text) - q] + following[:q]).encode()).hexdigest()
    assert np.median([r.near_edited for r in out]) > 0.3 > 0.1 > np.median([r.near_next for r in out])
    by_text = defaultdict(set)
    for r in out:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len(imatch.compare_with_edits(edge, imatch.lexicon(edge)).collect()) == 15
    assert imatch.compare_with_edits(empty, imatch.lexicon(empty)).collect() == []


def test_fingerprints_equal_a_plain_loop(real):
    """Lexicon, subsets and hashes recomputed term by term."""
    rows = real.select("doc_id", "text").collect()
    own = {r.doc_id: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", r.text.translate({i: i + 32 for i in range(65, 91)})) for r in rows}
    seen = Counter(t for terms in own.values() for t in set(terms))
    band = {t for t, n in seen.items() if max(2, math.ceil(0.001 * len(rows))) <= n <= 0.1 * len(rows)}
    assert len(imatch.lexicon(real)) == len(band)

    def hashed(term):
        data = np.frombuffer(term.encode(), dtype=np.uint8)
        return int(textscan.span_hashes(data, np.array([0]), np.array([len(data)]))[0])

    mix = lambda x: int(textscan.mix(np.array([x % 2**64], dtype=np.uint64))[0])
    prints = {r.doc_id: r.fingerprint for r in imatch.fingerprint_documents(real, imatch.lexicon(real)).collect()}
    for doc_id in sorted(own)[:12]:
        kept = [hashed(t) for t in sorted(set(own[doc_id]) & band)]
        if not kept:
            assert prints[doc_id].startswith("w:")
            continue
        expected = ""
        for level in range(imatch.LEVELS):
            for seed in imatch._SEEDS.tolist():
                subset = [x for x in (mix(t ^ seed) for t in kept) if x < 2 ** (64 - level)]
                expected += f"{max(1, mix(sum(subset)) >> 48) if subset else 0:04x}"
        assert prints[doc_id] == expected


def test_likeness_of_fingerprints():
    rng = np.random.default_rng(0)
    terms = rng.integers(1, 2**63, 900).astype(np.uint64)
    print_of = lambda x: imatch.subset_hashes(np.sort(x)).tobytes().hex()
    assert imatch.likeness(print_of(terms), print_of(terms)) == 1
    near, far = imatch.likeness(print_of(terms), print_of(terms[:850])), imatch.likeness(print_of(terms[:450]), print_of(terms[450:]))
    assert near > 0.5 > 0.1 > far
    assert imatch.likeness("w:a", print_of(terms)) == 0 and imatch.likeness("w:a", "w:a") == 1


def brute_tiles(a, b, shortest):
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for x in range(len(a)):
            for y in range(len(b)):
                n = 0
                while x + n < len(a) and y + n < len(b) and free_a[x + n] and free_b[y + n] and a[x + n] == b[y + n]:
                    n += 1
                best = max(best, (n, -x, -y))
        n, x, y = best[0], -best[1], -best[2]
        if n < shortest:
            return covered
        free_a[x : x + n], free_b[y : y + n] = [False] * n, [False] * n
        covered += n


def test_tiles_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(25):
        a, b = rng.integers(0, 4, 40).astype(np.uint64), rng.integers(0, 4, 25).astype(np.uint64)
        tiles = tiling.tile(a, b, 3)
        assert all((a[x : x + n] == b[y : y + n]).all() and n >= 3 for x, y, n in tiles)
        assert sum(n for _, _, n in tiles) == brute_tiles(a.tolist(), b.tolist(), 3)


def test_decontamination(spark, edge, empty):
    item = " ".join(f"w{i}" for i in range(30, 90))
    benchmark = spark.createDataFrame([(0, item), (1, item), (2, None), (3, ""), (4, "two"), (5, "a b c d e f g")], "item_id long, text string")
    for part_bytes in (tiling.PART_BYTES, 200):
        found = {(r.doc_id, r.item_id) for r in tiling.contaminated(edge, benchmark, part_bytes=part_bytes).collect()}
        holders = {1, 2, 3, 4, 10, 13}  # 3 has the passage in two moved parts
        assert found == {(d, i) for d in holders for i in (0, 1)} | {(7, 4), (8, 4)}
    kept = tiling.without_contaminated(edge, benchmark)
    assert kept.columns == edge.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([5, 6, None, 9, 11, 12])
    assert tiling.contaminated(empty, benchmark).collect() == [] and tiling.contaminated(edge, benchmark.limit(0)).collect() == []


def brute_spans(rows, length):
    held = defaultdict(set)
    for r in rows:
        w = words(r.text)
        for p in range(len(w) - length + 1):
            held[tuple(w[p : p + length])].add(r.doc_id if r.doc_id is not None else -1)
    out = defaultdict(set)
    for r in rows:
        w, own = words(r.text), r.doc_id if r.doc_id is not None else -1
        for p in range(len(w) - length + 1):
            holders = held[tuple(w[p : p + length])]
            if len(holders) > 1:
                out[r.doc_id, min(holders) == own].update(range(p, p + length))
    return out


@pytest.mark.parametrize("name", ["edge", "real"])
def test_repeated_passages(request, name):
    docs = request.getfixturevalue(name)
    got = defaultdict(set)
    for r in sparse_suffix.repeated_spans(docs, block_bytes=1 << 16).collect():
        got[r.doc_id, r.first].update(range(r.start, r.end))
    assert got == brute_spans(docs.select("doc_id", "text").distinct().collect(), 50)


def test_cut_passages(edge, empty):
    kept = sparse_suffix.without_repeats(edge)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert kept.columns == edge.columns
    assert texts[1] == edge.where("doc_id = 1").first().text and not {2, 4} & set(texts) and 3 not in texts
    assert {5, 7, 8, 9, 11, 12} <= set(texts)
    assert sparse_suffix.without_repeats(empty).collect() == []


def brute_groups(rows, k, limit):
    sets = []
    for r in rows:
        w = words(r.text)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= limit * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(r.doc_id, least.get(find(i), r.doc_id))
    return [(r.doc_id, len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)]


@pytest.mark.parametrize("name", ["edge", "real"])
def test_near_duplicates(request, name):
    docs = request.getfixturevalue(name)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect())
    assert got == Counter(brute_groups(docs.select("doc_id", "text").collect(), 4, 80))


def test_near_duplicates_of_a_chain_and_a_star(spark):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for d in range(160):
        text = list(base)
        for p in rng.choice(150, size=int(rng.integers(0, 9)), replace=False):
            text[p] = f"x{d}-{p}"
        rows.append((d, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect())
    assert got == Counter(brute_groups(docs.collect(), 4, 80))


def test_estimate_is_close(spark):
    a = " ".join(f"w{i}" for i in range(600))
    docs = spark.createDataFrame([(0, a), (1, a.replace("w300 ", "v "))], "doc_id long, text string")
    one, two = minhash.prints(docs).orderBy("doc_id").collect()
    row = spark.createDataFrame([(one.lanes, two.lanes)], "a array<long>, b array<long>").select(minhash.estimate("a", "b").alias("e")).first()
    assert row.e == pytest.approx(593 / 601, abs=0.04)


def test_keeping_one_of_each_group(edge, empty):
    kept = minhash.without_near_duplicates(edge, k=5)
    assert kept.columns == edge.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 5, 6, 7, None, 9, 11, 12])
    assert minhash.without_near_duplicates(empty).collect() == []


def test_one_of_each_group_stays_without_or_with_equal_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = [base.replace("w30 ", f"v{i} ") for i in range(4)]
    rows = [(None, near[0]), (None, near[1]), (None, near[2]), (7, "other " + " ".join(f"x{i}" for i in range(60))), (7, "another " + " ".join(f"x{i}" for i in range(60))), (8, ""), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = minhash.without_near_duplicates(docs, k=5).collect()
    assert Counter(r.doc_id for r in kept) == Counter([None, 7, 8, 8, 9])


def test_language(edge, real, empty):
    learn = blocks.crc_mod(F.col("doc_id"), 4) != 2
    model = language_id.train(real, learn)
    rows = language_id.predict(real, model, ~learn).join(real.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) > 0.97
    got = {r.doc_id: r for r in language_id.predict(edge, model, ~learn).collect()}
    assert all(got[i].lang_pred == "und" for i in (5, 6, 11, 12)) and all(0 <= r.score <= 1 for r in got.values())
    assert language_id.accepted(edge, model, 0.0).columns == edge.columns
    assert {r.doc_id for r in language_id.accepted(edge, model, 0.0).collect()} == {1, 2, 3, 4, 7, 8, None, 9, 10, 13}
    assert language_id.predict(empty, language_id.train(empty, learn), ~learn).collect() == []


def test_language_does_not_learn_from_other_rows(spark, real):
    """Held-out texts and rows without a language have no effect: the model stays the same to the last bit."""
    learn = blocks.crc_mod(F.col("doc_id"), 4) != 2
    unlabelled = F.col("doc_id") % 7 == 0
    before = real.withColumn("lang", F.when(~unlabelled, F.col("lang")))
    hidden = ~learn | unlabelled
    after = before.withColumn("text", F.when(hidden, F.lit("zq xj zq wholly other words 漢字")).otherwise(F.col("text")))
    after = after.withColumn("lang", F.when(~learn, F.lit("xx")).otherwise(F.col("lang")))
    one, two = language_id.train(before, learn), language_id.train(after, learn)
    assert one.languages == two.languages and one.temperature == two.temperature
    assert (one.idf == two.idf).all() and (one.weights == two.weights).all()


def test_language_sample_holds_rare_languages():
    shares = language_id.sample_shares({"en": 1_000_000, "de": 50_000, "rare": 40}, 10_000)
    assert shares["rare"] == 1 and 40 + 50_000 * shares["de"] + 1_000_000 * shares["en"] == pytest.approx(10_000)
    assert 50_000 * shares["de"] == pytest.approx(1_000_000 * shares["en"])


def test_language_scores_are_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("text", F.substring("text", 1, 12))
    learn = blocks.crc_mod(F.col("doc_id"), 4) != 2
    model = language_id.train(docs, learn)
    rows = language_id.predict(docs, model, ~learn).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").collect()
    sure = [r for r in rows if r.score > 0.9]
    assert model.temperature > 2e-4 and len(rows) > 200
    assert abs(np.mean([r.score for r in rows]) - np.mean([r.lang == r.lang_pred for r in rows])) < 0.06
    assert np.mean([r.lang == r.lang_pred for r in sure]) > 0.9


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(0)
    s = language_id.ftrl.Settings(alpha=0.5, beta=1.0, l1=0.02, l2=0.1, epochs=2)
    rows = [(np.sort(rng.choice(12, 4, replace=False)).astype(np.int32), rng.normal(size=4), int(rng.integers(3))) for _ in range(40)]
    z, n = np.zeros((12, 3)), np.zeros((12, 3))
    weight = lambda i, c: 0.0 if abs(z[i, c]) <= s.l1 else (math.copysign(s.l1, z[i, c]) - z[i, c]) / ((s.beta + math.sqrt(n[i, c])) / s.alpha + s.l2)
    for places, values, label in rows * s.epochs:
        w = {(i, c): weight(i, c) for i in places for c in range(3)}
        score = [sum(v * w[i, c] for i, v in zip(places, values)) for c in range(3)]
        p = np.exp(score) / np.exp(score).sum()
        for i, v in zip(places, values):
            for c in range(3):
                g = v * (p[c] - (c == label))
                z[i, c] += g - (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / s.alpha * w[i, c]
                n[i, c] += g * g
    expected = np.array([[weight(i, c) for c in range(3)] for i in range(12)])
    assert language_id.ftrl.fit_rows(rows, 12, 3, s) == pytest.approx(expected, abs=1e-12)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(4000, 3))
    p = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(3, p=x) for x in p])
    assert language_id.best_temperature(scores * 5, labels) == pytest.approx(5, rel=0.15)


def test_sharding(spark, edge, real, empty):
    got = rendezvous.placements(real, [1.0] * 8).collect()
    for shard in range(8):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
    assert all(r.grown_shard in (r.shard, 8) for r in got)
    rows = rendezvous.placements(edge, [1.0] * 8).collect()
    assert len(rows) == 15 and len({r.shard for r in rows if r.doc_id == 2}) == 1
    sizes = {r.doc_id: r.size for r in rows}
    assert sizes[6] == 1 and sizes[5] == 1 and sizes[7] == 8
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"))
    counts = Counter(r.shard for r in rendezvous.with_shards(keys, "doc_id", [1.0, 3.0]).collect())
    assert counts[1] / 20_000 == pytest.approx(0.75, abs=0.02)
    assert rendezvous.placements(empty, [1.0] * 8).collect() == []


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [(1, 0, "a", "add", '{"y":2, "x":1}', None), (1, 2, "b", "add", '{"x":"one"}', ["a"]), (1, 3, "c", "add", "not json", ["b", "zz"]), (1, 4, "a", "add", None, None),
         (1, 5, None, "none", '{"x":1}', None), (2, 0, "p", "add", '{"x":1,"y":2,"q":3}', ["q"]), (2, 1, "q", "add", '{"x":1,"y":2.5}', ["p"]), (2, 2, "r", "other", "{}", None)],
        "conv_id long, turn long, id string, name string, arguments string, after array<string>",
    )
    results = spark.createDataFrame([(1, 1, "a", 'so "it" is'), (1, 9, "zz", None), (2, 7, "r", "x")], "conv_id long, turn long, id string, content string")
    tools = spark.createDataFrame([("add", ["x", "y"], {"x": "integer", "y": "number"})], "name string, required array<string>, properties map<string,string>")
    got = {(r.conv_id, r.turn, r.kind): r for r in tool_calls.formatted(calls, results, tools).collect()}
    assert len(got) == 11
    assert [got[1, t, "call"].validity for t in (0, 2, 3, 4, 5)] == ["valid", "missing", "malformed", "missing", "unknown_tool"]
    assert [got[2, t, "call"].validity for t in (0, 1, 2)] == ["mistyped", "valid", "unknown_tool"]
    assert [got[1, t, "call"].status for t in (0, 2, 4, 5)] == ["linked", "pending", "repeated", "pending"]
    assert [got[1, t, "call"].layer for t in (0, 2, 3)] == [0, 1, 2] and got[2, 0, "call"].layer is None
    assert got[1, 1, "result"].status == "linked" and (got[1, 1, "result"].anchor, got[1, 1, "result"].step) == (0, 1)
    assert got[1, 9, "result"].status == "orphan"
    assert got[1, 0, "call"].json == '{"arguments":{"x":1,"y":2},"id":"a","name":"add"}'
    assert got[1, 1, "result"].json == '{"content":"so \\"it\\" is","role":"tool","tool_call_id":"a"}'
    assert all(json.loads(r.json) is not None for r in got.values())
    assert tool_calls.formatted(calls.limit(0), results.limit(0), tools).collect() == []


def test_tool_calls_with_ties_and_without_a_conversation(spark):
    calls = spark.createDataFrame(
        [(None, 0, "a", "t", "{}", None, 1), (None, 1, "b", "t", "{}", ["a"], 2), (None, 2, "c", "t", "{}", ["b"], 3), (1, 0, "x", "t", '{"k":1}', None, 4), (1, 0, "x", "t", "{}", None, 5), (1, 0, "x", "t", "{}", None, 6)],
        "conv_id long, turn long, id string, name string, arguments string, after array<string>, status long",
    )
    results = spark.createDataFrame([(1, 3, "x", "r"), (1, 3, "x", "q"), (None, 5, "b", "r")], "conv_id long, turn long, id string, content string").withColumns({"json": F.lit(1), "layer": F.lit(9)})
    tools = spark.createDataFrame([("t", [], {"k": "integer"})], "name string, required array<string>, properties map<string,string>")
    got = tool_calls.formatted(calls, results, tools).collect()
    assert {r.id: r.layer for r in got if r.conv_id is None and r.kind == "call"} == {"a": 0, "b": 1, "c": 2}
    assert Counter(r.status for r in got if r.conv_id == 1 and r.kind == "call") == {"linked": 1, "repeated": 2}
    assert {(r.status, r.json) for r in got if r.conv_id == 1 and r.kind == "result"} == {("linked", '{"content":"q","role":"tool","tool_call_id":"x"}'), ("repeated", '{"content":"r","role":"tool","tool_call_id":"x"}')}
    assert [r.status for r in got if r.conv_id is None and r.kind == "result"] == ["linked"]


def test_pipeline_stages_keep_columns_and_clean_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data)
        assert docs.columns == columns
    assert before * 0.6 < docs.count() <= before
    assert corpus_pipeline.run(spark, data).count() > 0


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_tool_calls_read_off_texts_show_every_case(spark):
    texts = ["x" * n for n in range(1, 140)]
    rows = [(n % 9, n, "user" if n % 2 else "assistant", t) for n, t in enumerate(texts)] + [(50, 0, "user", None), (50, 1, None, "no role"), (None, 0, "assistant", "y" * 9)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    calls, results = tool_calls.from_conversations(messages)
    tools = spark.createDataFrame(catalog.TOOLS, "name string, required array<string>, properties map<string,string>")
    got = tool_calls.formatted(calls, results, tools).collect()
    assert len(got) == len(rows) - 1
    assert {r.status for r in got} == {"linked", "pending", "orphan", "repeated"}
    assert {r.validity for r in got if r.kind == "call"} == {"valid", "malformed", "unknown_tool", "missing", "mistyped"}
    layers = {r.layer for r in got if r.kind == "call" and r.id is not None}
    assert None in layers and 0 in layers and max(x for x in layers if x is not None) >= 1
    assert tool_calls.formatted(*tool_calls.from_conversations(messages.limit(0)), tools).collect() == []


def test_packing_encodes_small_slices_and_remembers_few_units(monkeypatch):
    """Ids do not depend on the slice, the window of the hashes or what is remembered; the room for them does."""
    draw = np.random.default_rng(4)
    texts = [" ".join(f"word{i}" for i in draw.integers(3000, size=400)) + " \U0001f600" * (n % 3) for n in range(40)]
    plain = textscan.slices(pa.array(texts), 1 << 30)
    _, data, offsets = next(plain)
    whole, counts = packing.UnitEncoder(VOCABULARY, ADDED).encode(data, offsets)
    assert packing.SLICE_BYTES <= 1 << 19 and packing.UNITS <= 500_000
    monkeypatch.setattr(packing, "SLICE_BYTES", 5000)
    monkeypatch.setattr(packing, "UNITS", 1000)
    encoder, parts = packing.UnitEncoder(VOCABULARY, ADDED), []
    for _, some, places in textscan.slices(pa.array(texts), packing.SLICE_BYTES):
        parts.append(encoder.encode(some, places))
        assert textscan._powers.size == 5001
    assert np.array_equal(np.concatenate([p[0] for p in parts]), whole) and np.array_equal(np.concatenate([p[1] for p in parts]), counts)
    assert len(encoder.known) < 3000


def test_pipeline_steps_hold_small_parts_and_leave_no_freed_batches(monkeypatch):
    """Decontamination works and answers in small parts and gives freed batches back, with the rows of the whole batch."""
    item = " ".join(f"w{i}" for i in range(40))
    texts = [None if i % 7 == 0 else "" if i % 11 == 0 else f"x{i} " + (item if i % 5 == 0 else f"y{i} z") for i in range(2500)]
    spread = SimpleNamespace(value=tiling._index(pa.table({"item_id": [0, 1], "text": [item, "none of these words here"]}), tiling.MIN_TILE))
    batch = pa.record_batch({"doc_id": pa.array(range(2500)), "text": pa.array(texts)})
    released = []
    monkeypatch.setattr(pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: released.append(1)))
    out = list(tiling._filter(spread, tiling.COVERAGE, tiling.MIN_TILE)(iter([batch, batch.slice(0, 0), batch.slice(3, 9)])))
    assert len(released) == 4 and textscan._powers.size == textscan.SMALL_SLICE_BYTES + 1 <= (1 << 19) + 1
    assert max(x.num_rows for x in out) <= textscan.PART_ROWS
    kept = [i for i, text in enumerate(texts) if item not in (text or "")]
    assert [i for x in out for i in x["doc_id"].to_pylist()] == kept + [i for i in kept if 3 <= i < 12]
