"""Properties of the marts on data derived from the smallest generated tables."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ampere.operators.upsert import upsert
from ampere.plans import marts
from ampere.plans import queries as Q
from ampere.plans.exports import generation_by_category
from ampere.plans.staging import GENERATION_KEYS
from tests.conftest import SF_SMALL


def test_upsert_is_idempotent_on_real_batches(spark):
    target = Q.staged(spark, SF_SMALL, "generation", "backfill")
    batch = Q.staged(spark, SF_SMALL, "generation", "revision")
    once = upsert(target, batch, GENERATION_KEYS)
    twice = upsert(once, batch, GENERATION_KEYS)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    # the revision replaced exactly its own keys
    assert once.count() == target.count() + batch.join(target, list(GENERATION_KEYS),
                                                       "left_anti").count()


def test_shares_sum_to_one_and_categories_add_up(spark):
    fact = Q.fact_generation(spark, SF_SMALL)
    sums = (fact.groupBy("period", "state_id")
            .agg(F.sum("generation_share").alias("s"), F.sum("generation_mwh").alias("t"))
            .filter(F.col("t") != 0).collect())
    assert sums and all(math.isclose(r.s, 1.0, rel_tol=1e-9) for r in sums)
    by_code = fact.agg(F.sum("generation_mwh")).first()[0]
    by_cat = generation_by_category(fact).agg(F.sum("generation_mwh")).first()[0]
    assert math.isclose(by_code, by_cat, rel_tol=1e-12)


def test_zscore_bounded_by_window_size(spark):
    fact = Q.fact_retail(spark, SF_SMALL)
    n = F.least(F.row_number().over(Window.partitionBy("state_id").orderBy("period")), F.lit(12))
    bad = (fact.withColumn("n", n)
           .filter(F.abs("z_score") > (F.col("n") - 1) / F.sqrt("n") + 1e-9).count())
    assert bad == 0
    # an anomaly needs at least 9 rows in the window, as |z| <= (n-1)/sqrt(n)
    early = (fact.withColumn("n", n).filter(F.col("is_anomaly") & (F.col("n") < 9)).count())
    assert early == 0


def test_heatmap_cells_bounded(spark):
    stg = Q.current_staging(spark, SF_SMALL, "demand")
    heat = marts.fact_rto_heatmap(stg)
    months = stg.select(F.trunc(F.to_date("period"), "MM")).distinct().count()
    regions = stg.select("region_id", "region_name").distinct().count()
    assert 0 < heat.count() <= 24 * months * regions
    assert heat.filter((F.col("hour_of_day") < 0) | (F.col("hour_of_day") > 23)).count() == 0
