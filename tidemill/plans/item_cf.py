"""Item-based collaborative filtering, from preferences to recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill import schemas
from tidemill.operators.ranking import top_per_key
from tidemill.operators.scoring import unseen_scores
from tidemill.operators.similarity import rating_cells, similarity_of_cells
from tidemill.session import stage
from tidemill.sources.text import read_delimited


def similarities_and_recommendations(
    prefs: DataFrame, method: str = "cooccurrence", n: int = 30
) -> tuple[DataFrame, DataFrame]:
    """Item similarities, and each user's ``n`` best unseen items.

    Both work on the same stored cells, so the preferences are read once.
    """
    cells = stage(rating_cells(prefs), "cells", together="user_id")
    sims = stage(similarity_of_cells(cells, method), "similarities")
    recs = top_per_key(unseen_scores(sims, cells), "user_id", "pref", "item_id", n)
    return sims, recs


def item_cf_from_text(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    prefs = read_delimited(spark, path, schemas.PREFS, sep=",")
    sims, recs = similarities_and_recommendations(prefs)
    return {"similarities": sims, "recommendations": recs}
