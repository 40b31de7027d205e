import pytest
from pyspark.sql import functions as F

CLASHING = ["score", "block", "bucket", "kept", "text_key", "node", "key", "row", "part", "shard", "slot", "first", "n", "word", "word_id", "lang_pred"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, copies, equal ids and columns whose names clash with the operators' own."""
    base = " ".join(f"w{i}" for i in range(120))
    rows = [
        (1, base), (2, base), (2, base), (3, ""), (4, None), (None, "no id here " * 30), (None, None), (5, "x" * 300_000), (6, " " * 5000), (7, "<|endoftext|> <s> </s> <unk> <0x41>"),
        (8, " \n\t leading, and  double   spaces \r\n"), (9, "Straße déjà-vu ÀÉÎ ×÷ 漢字かな \U0001f600 ▁▁ literal ▁bar"), (10, "a\x00b \x7f"), (11, ("Nachbarschaft nachbarschaft Nachbarschft " * 40)),
        (12, "ab" * 40_000), (13, " nbsp em　wide"), (14, "don't we'll I'M 12345 67,890.12"), (15, "\n\n\n\n" * 300), (16, " "),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})
