"""A store that grows by days, and rules counted while writing."""

import datetime as dt

from pyspark.sql import functions as F

from shelfspan.operators import quality
from shelfspan.plans import store
from shelfspan.schemas import CALENDAR_TEXT
from shelfspan.session import shared_path
from shelfspan.sources.tables import write_checked


def integrated(small_panel):
    named = F.when(F.dayofmonth("date") == 1, "first")
    return small_panel.withColumns({c: named for c in CALENDAR_TEXT}).withColumns({c: F.lit(0) for c in ("snap_CA", "snap_TX", "snap_WI")})


def rows_of(spark, path):
    table = store.read_store(spark, path)
    numbers = [f.name for f in table.schema.fields if f.dataType.typeName() == "double"]
    table = table.withColumns({c: F.round(c, 9) + 0.0 for c in numbers})
    return table.columns, sorted(map(str, table.select(*sorted(table.columns)).collect()))


def test_store_grown_by_days_equals_the_store_built_at_once(spark, small_panel):
    days = integrated(small_panel)
    whole, grown = shared_path(spark, "whole"), shared_path(spark, "grown")
    store.create_store(days, whole)
    cuts = [dt.date(2020, 1, 1), dt.date(2020, 2, 10), dt.date(2020, 2, 11), dt.date(2020, 3, 5), dt.date(2020, 4, 1)]
    store.create_store(days.where(F.col("date") < F.lit(cuts[1])), grown)
    for a, b in zip(cuts[1:], cuts[2:], strict=False):
        piece = days.where((F.col("date") >= F.lit(a)) & (F.col("date") < F.lit(b)))
        assert store.append_days(piece, grown) is not None
    assert rows_of(spark, grown) == rows_of(spark, whole)
    # The same days again change nothing; no days write nothing.
    store.append_days(days.where(F.col("date").between("2020-02-20", "2020-02-25")), grown)
    assert store.append_days(days.limit(0), grown) is None
    assert rows_of(spark, grown) == rows_of(spark, whole)


def test_corrected_rows_reach_all_later_features(spark, small_panel):
    days = integrated(small_panel)
    hit = (F.col("id") == "I1_S1") & (F.col("date") == "2020-02-15")
    corrected = days.withColumn("demand", F.when(hit, 99).otherwise(F.col("demand")).cast("long"))
    whole, mended = shared_path(spark, "whole"), shared_path(spark, "mended")
    store.create_store(corrected, whole)
    store.create_store(days, mended)
    store.append_days(corrected.where(hit), mended)
    assert rows_of(spark, mended) == rows_of(spark, whole)


def test_append_reads_the_months_of_the_look_back_only(spark, small_panel, monkeypatch):
    days, path, plans = integrated(small_panel), shared_path(spark, "pruned"), []
    store.create_store(days.where(F.col("date") < "2020-03-20"), path)
    plain = store._write
    monkeypatch.setattr(store, "_write", lambda df, *more, **named: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or plain(df, *more, **named))
    store.append_days(days.where(F.col("date") >= "2020-03-20"), path)
    assert "202002" in plans[0] and "202003" in plans[0] and "202001" not in plans[0]


def test_rules_counted_while_writing_equal_those_of_a_scan(spark, small_panel):
    table = small_panel.withColumn("demand", F.when(F.col("day_num") < 40, F.lit(None)).otherwise(F.col("demand") - 1))
    rules = quality.feature_store_rules(table)
    path = shared_path(spark, "checked")
    report = write_checked(table, path, "feature_store", rules)
    assert report.schema.simpleString() == quality.run_rules(table, "feature_store", rules).schema.simpleString()
    assert sorted(report.collect()) == sorted(quality.run_rules(spark.read.parquet(path), "feature_store", rules).collect())
    assert sum(r.violations for r in report.collect()) > 0
    empty = write_checked(table.limit(0), shared_path(spark, "empty"), "feature_store", rules)
    assert sorted(empty.collect()) == sorted(quality.run_rules(table.limit(0), "feature_store", rules).collect())
    assert write_checked(table, shared_path(spark, "unruled"), "feature_store", []).count() == 0
