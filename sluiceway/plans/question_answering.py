"""Questions to prompts: validate, embed, retrieve, assemble."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from sluiceway.operators.requests import check_retrieval_requests
from sluiceway.operators.retrieval import build_prompts, hash_embedding, nearest, searchable, with_passages
from sluiceway.session import to_scratch_table


def prompts_for(
    requests: DataFrame,
    corpus: DataFrame,
    embed: Callable[[DataFrame], DataFrame] | None = None,
    passages: DataFrame | None = None,
) -> DataFrame:
    """Prompts for the valid requests (query_id, query, maybe top_k, temperature, embedding).

    `corpus` has vec_id and embedding; its text and metadata come from `passages`, or from the corpus
    itself; vectors without a passage are not searched. Requests without an embedding column are embedded with `embed`, hashed words by default.
    The largest top_k is searched once and each request keeps its own number of hits.
    """
    asked = check_retrieval_requests(requests).where("valid")
    if "embedding" not in asked.columns:
        asked = (embed or (lambda df: hash_embedding(df, "query")))(asked)
    # Stored, so that an embedding model sees each question once.
    asked = to_scratch_table(asked.select("query_id", "query", "top_k", "embedding"), "questions")
    most = asked.agg(F.max("top_k")).first()[0]
    if most is None:
        most = 1
    vectors = corpus.select("vec_id", "embedding")
    hits = nearest(asked.select("query_id", "embedding"), vectors if passages is None else searchable(vectors, passages), most)
    own = hits.join(asked.select("query_id", "top_k"), "query_id").where(F.col("rank") <= F.col("top_k")).drop("top_k")
    found = with_passages(own, corpus if passages is None else passages)
    return build_prompts(asked.select("query_id", "query"), found)
