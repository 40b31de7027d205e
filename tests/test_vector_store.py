import threading

import pytest

from sluiceway.operators.vector_store import VectorStore, create_once


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, f"text {i}", [float(i), 1.0], "extra") for i in range(40)], "n int, text string, embedding array<float>, first string")


def test_writers_at_once_and_a_repeated_batch(spark, rows, tmp_path):
    store, path = VectorStore(spark, str(tmp_path / "store")), str(tmp_path / "store")
    firsts = {}

    def write(key, low, high):
        firsts.setdefault(key, set()).add(VectorStore(spark, path).append(rows.where(f"n >= {low} and n < {high}"), key, ["n"]))

    parts = {"a": (0, 10), "b": (10, 25), "c": (25, 40)}
    threads = [threading.Thread(target=write, args=(k, *v)) for k, v in parts.items()]
    [t.start() for t in threads]
    [t.join() for t in threads]
    write("b", 10, 25)
    found = store.read().orderBy("vec_id").collect()
    assert [r.vec_id for r in found] == list(range(40)) and all(len(x) == 1 for x in firsts.values())
    for key, (low, high) in parts.items():
        first = next(iter(firsts[key]))
        assert [r.text for r in found[first : first + high - low]] == [f"text {i}" for i in range(low, high)]
    assert store.pending() == [] and store.entries().count() == 3


def test_broken_writers_leave_a_range_that_a_repeat_fills(spark, rows, tmp_path):
    store = VectorStore(spark, f"file://{tmp_path}/a store".replace(" ", "-"))
    assert store.read().count() == 0 and store.pending() == []
    store._claim("lost", 10)
    assert store.append(rows.where("n >= 10"), "next", ["n"]) == 10
    assert store.pending() == ["lost"] and store.read().agg({"vec_id": "min"}).first()[0] == 10
    assert store.append(rows.where("n < 10"), "lost", ["n"]) == 0
    assert store.pending() == [] and [r.vec_id for r in store.read().orderBy("vec_id").collect()] == list(range(40))
    with pytest.raises(ValueError, match="rows before"):
        store.append(rows, "lost", ["n"])


def test_nulls_copies_and_empty_batches(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([(1, None, None, None), (2, "", [0.0, 0.0], {"k": "v"}), (2, "", [0.0, 0.0], None)], "n int, text string, embedding array<float>, metadata map<string,string>")
    assert store.append(df.limit(0), "none", ["n"]) == 0
    assert store.append(df, "some", ["n"]) == 0
    assert store.append_texts(df.drop("embedding"), "texts", ["n"]) == 3
    found = store.read().orderBy("vec_id").collect()
    assert [r.vec_id for r in found] == list(range(6)) and found[0].embedding is None and found[0].metadata == {}
    assert len(found[3].embedding) == 256 and set(found[3].embedding) == {0.0}


def test_a_file_is_made_once(spark, tmp_path):
    path, won = str(tmp_path / "ledger" / "0.json"), []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if create_once(spark, path, f"{i}") else None) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and open(path).read() == str(won[0]) and [p.name for p in (tmp_path / "ledger").iterdir()] == ["0.json"]
