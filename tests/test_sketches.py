"""Key sketches that are kept by day, and jobs that read nothing for hot keys."""

import random
from functools import reduce

from conftest import got
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import roles
from checks.registry import RUN, Tables
from dayledger import RunDate, plans
from dayledger.operators import hot_keys, hot_keys_each, sketch_days
from dayledger.sinks import stage
from dayledger.sources import Catalog

DAYS = ["20240601", "20240602", "20240603"]


def skewed(spark):
    rng = random.Random(3)
    rows = [(ds, 7 if rng.random() < 0.4 else rng.randrange(5000), rng.choice(["a", None])) for ds in DAYS for _ in range(3000)]
    rows += [("20240602", 9, "b")] * 2500 + [("20240603", None, "c")] * 4000
    return spark.createDataFrame(rows, "ds string, k long, v string").repartition(5)


def test_kept_sketches_find_the_keys_that_a_scan_finds(spark):
    df = skewed(spark)
    kept = stage(reduce(DataFrame.unionByName, [sketch_days(df, "t", ["k"], [ds], share=0.05) for ds in DAYS]), "kept")
    assert got(kept, "ds", "n") == got(df.where("k IS NOT NULL").groupBy("ds").agg(F.count("*").alias("n")))
    want = hot_keys(df, ["k"], share=0.05, min_rows=100)
    assert want == [(7,), (9,)]
    stored = kept.select("n", "sketch")
    assert hot_keys_each([(df, ["k"])], 0.05, 100, [stored])[0] == want
    # together with relations that have none, and of fewer days
    other = hot_keys_each([(df, ["k"]), (df, ["v"]), (df.where("ds = '20240601'"), ["k"])], 0.05, 100, [stored, None, kept.where("ds = '20240601'")])
    assert other == [want, hot_keys(df, ["v"], 0.05, 100), [(7,)]]
    shares = [round(k.share, 6) for k in hot_keys_each([(df, ["k"])], 0.05, 100, [stored])[0]]
    assert shares == [round(k.share, 6) for k in want]


def test_days_without_rows(spark):
    df = skewed(spark)
    kept = stage(sketch_days(df, "t", ["k"], ["20240601", "20240605"], share=0.05), "kept")
    assert got(kept, "ds", "n")[1] == ("20240605", 0)
    catalog = Catalog(spark, {}, sketches=kept)
    assert catalog.sketch("t", ["k"], ["20240605"]).count() == 0
    none = df.where("ds = '20240605'")
    assert hot_keys_each([(none, ["k"])], 0.05, 1, [catalog.sketch("t", ["k"], ["20240605"])]) == [[]]
    assert catalog.sketch("t", ["k"], ["20240601", "20240605"]).count() == 1
    assert catalog.sketch("t", ["k"], ["20240601", "20240602"]) is None  # a day is lacking
    assert catalog.sketch("t", ["v"], ["20240601"]) is None and catalog.sketch("u", ["k"], ["20240601"]) is None
    twice = Catalog(spark, {}, sketches=kept.unionByName(kept))
    assert twice.sketch("t", ["k"], ["20240601"]).count() == 1
    assert Catalog(spark, {}).sketch("t", ["k"], ["20240601"]) is None


def test_a_job_with_kept_sketches_makes_none(spark, monkeypatch):
    catalog = roles.order_material(Tables(spark, "/root/testdata/sf0.001"))
    kept = stage(plans.order_material_sketches(catalog, RUN, before=7), "sketches")
    one = plans.order_material_sketches(catalog, RunDate.parse(RUN.days_before(2)))
    same = ["relation", "keys", "ds", "n"]
    bridge = "relation = 'bridge, keyed' AND ds = '" + RUN.days_before(2) + "'"
    assert got(one.where(bridge).select(same)) == got(kept.where(bridge).select(same))
    called = []
    real = F.call_function
    monkeypatch.setattr(F, "call_function", lambda name, *cols: called.append(name) or real(name, *cols))
    for job in (plans.order_material_fallback, plans.order_material_three_level, plans.order_material_detail):
        want = got(job(catalog, RUN, max_bytes=0))
        assert "approx_top_k_accumulate" in called
        called.clear()
        assert got(job(Catalog(spark, catalog.tables, sketches=kept), RUN, max_bytes=0)) == want
        assert "approx_top_k_accumulate" not in called and "approx_top_k_combine" in called
        called.clear()
