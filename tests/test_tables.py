from pyspark.sql import functions as F

from assetflow.plans import tables
from assetflow.plans.views import Views
from assetflow.session import scratch_path
from paths import SF_SMALL


def test_views_by_name_equal_the_frames(spark):
    names = tables.create_views(spark, SF_SMALL)
    assert "feature_table" in names
    v = Views(spark, SF_SMALL)
    by_name = spark.sql("SELECT * FROM feature_table")
    assert by_name.columns == v.features.columns
    assert by_name.exceptAll(v.features).count() == 0 and by_name.count() == v.features.count()


def test_tables_snapshot_predictions_and_reset(spark, tmp_path):
    db = "assetflow_test"
    tables.reset(spark, db)
    try:
        assert {t.name for t in spark.catalog.listTables(db) if not t.isTemporary} == set(tables.TABLES)
        path = scratch_path(spark, "snapshot")
        rows = Views(spark, SF_SMALL).enriched
        rows.write.parquet(path)
        name = f"{db}.enriched_readings"
        assert tables.load_snapshot(spark, path, name) and spark.table(name).count() == rows.count()
        assert not tables.load_snapshot(spark, path, name)  # what is there stays
        assert tables.load_snapshot(spark, path, name, replace=True) and spark.table(name).count() == rows.count()
        sums = lambda d: d.agg(F.sum("sensor1"), F.sum("sensor9")).first()
        assert [round(x, 6) for x in sums(spark.table(name))] == [round(x, 6) for x in sums(rows)]
        tables.save_predictions(rows.select("reading_date", "asset_id", "sensor1"), f"{db}.predictions")
        tables.save_predictions(rows.select("reading_date", "asset_id", "sensor1").limit(5), f"{db}.predictions")
        assert spark.table(f"{db}.predictions").count() == 5
        tables.create_tables(spark, db)  # again: nothing is lost
        assert spark.table(name).count() == rows.count()
        tables.reset(spark, db)
        assert spark.table(name).isEmpty() and not spark.catalog.tableExists(f"{db}.predictions")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
