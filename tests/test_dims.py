from __future__ import annotations

from orderflow.operators import dims
from orderflow.schemas import DIM_SCHEMAS


def frames(spark, brand=None, item=None):
    brand = brand or [(1, "b1"), (2, "b2")]
    d = {
        "brand": spark.createDataFrame(brand, "id bigint, name string"),
        "menu": spark.createDataFrame([(11, "m", 1)], "id bigint, name string, brand_id bigint"),
        "category": spark.createDataFrame([(111, "c", 11, 1)],
                                          "id bigint, name string, menu_id bigint, brand_id bigint"),
        "item": spark.createDataFrame(item or [(5, "i", None, 1.0, None, 1, 11, 111)],
                                      DIM_SCHEMAS["item"]),
    }
    return d


def violations(df):
    return {(r.table, r.rule, r.column): r.violations for r in df.collect() if r.violations}


def test_clean_dims_have_no_violations(spark):
    assert violations(dims.check_integrity(frames(spark))) == {}


def test_planted_violations(spark):
    d = frames(spark, brand=[(1, "b1"), (1, "dup"), (2, None)],
               item=[(5, "i", None, 1.0, None, 9, 11, 111), (6, "j", None, 2.0, None, 9, 11, 111)])
    v = violations(dims.check_integrity(d))
    assert v == {("brand", "primary_key", "id"): 1, ("brand", "not_null", "name"): 1,
                 ("item", "foreign_key", "brand_id->brand"): 2}


def test_enrich_keeps_unknown_keys(spark):
    d = frames(spark)
    df = spark.createDataFrame([(1, 11, 111, 5), (7, 11, 111, 5)],
                               "brand_id int, menu_id int, category_id int, item_id int")
    rows = sorted(dims.enrich(df, d).collect(), key=lambda r: r.brand_id)
    assert [(r.brand_id, r.brand_name, r.menu_name, r.category_name, r.item_name) for r in rows] == \
        [(1, "b1", "m", "c", "i"), (7, None, "m", "c", "i")]


def test_load_dims_writes_tables(spark, tmp_path):
    names = dims.load_dims(spark, frames(spark), "orderflow_test_dims", str(tmp_path / "db"))
    assert [f.name for f in spark.table(names["item"]).schema] == DIM_SCHEMAS["item"].fieldNames()
    assert spark.table(names["brand"]).count() == 2


def test_read_dims_from_files(spark):
    """Dimension files written under their original names read back."""
    from orderflow.session import scratch_path
    from orderflow.sources import fixtures
    path = scratch_path(spark, "test-dim-files")
    derived = fixtures.dims_from_part(spark, "/root/testdata/sf0.001")
    for name, fname in dims.DIM_FILES.items():
        derived[name].write.parquet(f"{path}/{fname}.parquet")
    back = dims.read_dims(spark, path)
    assert set(back) == {"brand", "menu", "category", "item"}
    assert back["item"].count() == derived["item"].count()
    assert violations(dims.check_integrity(back)) == {}
