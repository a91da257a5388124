import json
import os

import pytest

from isobar import schemas
from isobar.config import Period, periods_frame
from isobar.operators import catalog, document, normals
from tests.test_normals import ROWS


def _docs(spark):
    daily = spark.createDataFrame(ROWS, schemas.DAILY)
    per = periods_frame(spark, [Period(2000, 2002)])
    return document.statistics_documents(normals.period_summary(daily, per),
                                         normals.monthly_normals(daily, per, sort=False))


def test_document_write_and_flatten(spark, tmpdir_path):
    docs = _docs(spark)
    out = os.path.join(tmpdir_path, "docs")
    document.write_documents(docs, out)
    back = {}
    for root, _, names in os.walk(out):
        for n in names:
            if n.startswith("part-"):
                with open(os.path.join(root, n)) as fh:
                    for line in fh:
                        if line.strip():
                            back[os.path.basename(os.path.dirname(root))] = json.loads(line)
    doc = back["station=A"]
    keys = list(doc)
    assert keys[0] == "_comments" and keys[1] == "Avg_TempAvg"
    assert keys.index("Avg_Days_Precipitation_20") < keys.index("January")
    assert doc["January"]["Max_TempHigh"] == {"Max": 5.0, "Min": 0.0}
    assert doc["Max_TempHigh"][0] == {"Date": "2000-06-01", "Value": "30.0"}
    flat = {r.metric: (r.value, r.description) for r in
            document.describe(document.flatten_document(docs)).filter("station = 'A'").collect()}
    assert flat["January_Max_TempHigh_Max"][0] == "5.0"
    assert flat["Avg_TempAvg"][1] == "Average temperature of daily mean temperatures"
    assert flat["_comments_Avg_TempAvg"][0] == "Average temperature of daily mean temperatures"
    assert json.loads(flat["Max_TempHigh"][0])[0]["Value"] == "30.0"
    assert flat["April_Avg_TempAvg"][0] is None


def test_discover_and_consolidate(spark):
    with pytest.raises(ValueError):
        catalog.discover_tables(spark, "NoSuchTable_*")
    spark.range(2).createOrReplaceTempView("Normals_2000_2001")
    spark.range(3).createOrReplaceTempView("Normals_2001_2002")
    spark.range(5).createOrReplaceTempView("NormalsX")
    names = catalog.discover_tables(spark, "Normals_*")
    assert [n.lower() for n in names] == ["normals_2000_2001", "normals_2001_2002"]
    u = catalog.consolidate(spark, names, prefix="Lille_")
    assert u.count() == 5
    assert {r.source_table.lower() for r in u.collect()} == {"lille_normals_2000_2001",
                                                             "lille_normals_2001_2002"}
    for v in ("Normals_2000_2001", "Normals_2001_2002", "NormalsX"):
        spark.catalog.dropTempView(v)


def test_tables_of_several_databases(spark, tmpdir_path):
    import uuid
    tag = uuid.uuid4().hex[:6]
    for i, name in enumerate(("lille", "paris", "other")):
        spark.sql(f"CREATE DATABASE {name}_{tag} LOCATION '{tmpdir_path}/{name}'")
        catalog.save_table(spark.createDataFrame([(i, "a")], "k int, v string"), f"{name}_{tag}.Normals_1991_2020", keys=["k"])
    catalog.save_table(spark.createDataFrame([(7, "b")], "k int, v string"), f"lille_{tag}.daily", keys=["k"])
    names = catalog.discover_tables(spark, "normals_*", f"*_{tag}")
    assert len(names) == 3
    out = {(r.source_table.lower(), r.k) for r in catalog.consolidate(spark, names).collect()}
    assert out == {(f"{n}_{tag}_normals_1991_2020", i) for i, n in enumerate(("lille", "paris", "other"))}
    assert {r.source_table.lower() for r in catalog.consolidate(spark, names[:1], "x_").collect()} == {"x_normals_1991_2020"}
    with pytest.raises(ValueError, match="no table matches"):
        catalog.discover_tables(spark, "normals_*", "nowhere_*")
