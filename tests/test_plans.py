"""Specification, routing, metadata and schema rules; ingestion runs."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import family as fm
from tidemark.operators import partition as pt
from tidemark.operators import select as sl
from tidemark.plans.ingest import Ingestion, register_transform, route
from tidemark.plans.meta import TableMeta, check_metadata, infer_type, table_metadata
from tidemark.plans.schema import schema_from_descriptors, schema_from_header
from tidemark.plans.spec import PipelineSpec, TableSpec
from tidemark.sources.files import Landed

VALID = {"connection_name": "c", "objects": [{"table": {"source_table": "t"}}]}


@pytest.mark.parametrize("bad", [
    "x", {}, {"connection_name": "c"}, {"connection_name": " ", "objects": VALID["objects"]}, {"connection_name": "c", "objects": []},
    {**VALID, "extra": 1}, {"connection_name": "c", "objects": [{}]}, {"connection_name": "c", "objects": [{"table": {}}]},
    {"connection_name": "c", "objects": [{"table": {"source_table": 5}}]},
    {"connection_name": "c", "objects": [{"table": {"source_table": "t", "oops": 1}}]},
    {"connection_name": "c", "objects": [{"table": {"source_table": "t", "table_configuration": "x"}}]}, {"connection_name": 3, "objects": VALID["objects"]},
])
def test_invalid_specifications(bad):
    with pytest.raises(ValueError):
        PipelineSpec.parse(bad)


def _table(**config):
    return TableSpec.parse({"source_table": "t", "table_configuration": config})


def test_table_overrides():
    t = _table(scd_type="scd_type_2", primary_keys=["a", "b"], sequence_by="s", cluster_by="x, y", depth=3, nested={"k": 1})
    assert (t.scd_type, t.primary_keys, t.sequence_by, t.cluster_by) == ("SCD_TYPE_2", ["a", "b"], "s", ["x", "y"])
    assert t.options == {"depth": "3", "nested": '{"k": 1}'}
    assert _table(primary_keys="a").primary_keys == ["a"] and _table(cluster_by=["p"]).cluster_by == ["p"] and _table(cluster_by=" ").cluster_by is None
    with pytest.raises(ValueError):
        _ = _table(scd_type="SCD_9").scd_type
    full = TableSpec.parse({"source_table": "t", "destination_catalog": "c", "destination_schema": "s", "destination_table": "d"})
    assert full.destination == "`c`.`s`.`d`" and _table().destination == "t"
    assert TableSpec.parse({"source_table": "t", "destination_catalog": "c"}).destination == "t"


def test_routing():
    cdc = TableMeta(["id"], "ts", "cdc")
    assert route(_table(), cdc).kind == "upsert" and route(_table(scd_type="APPEND_ONLY"), cdc).kind == "append"
    assert route(_table(), TableMeta(["id"], None, "snapshot")).kind == "snapshot"
    assert route(_table(), TableMeta(["id"], "ts", "cdc_with_deletes")).with_deletes
    assert route(_table(), TableMeta(["id"], "ts", "mystery")).kind == "upsert"
    f = route(_table(primary_keys="k", sequence_by="s", scd_type="SCD_TYPE_2"), cdc)
    assert (f.keys, f.sequence, f.scd_type) == (["k"], "s", 2)
    for meta in (TableMeta([], "ts", "cdc"), TableMeta(["id"], None, "cdc")):
        with pytest.raises(ValueError):
            route(_table(), meta)


def test_metadata_rules(spark):
    schema = T._parse_datatype_string("id int, s struct<ts:string>")
    assert check_metadata(TableMeta(["id"], "s.ts", "cdc"), schema) == []
    assert len(check_metadata(TableMeta([], None, "cdc"), schema)) == 2
    assert len(check_metadata(TableMeta(["x"], "s.no", "odd"), schema)) == 3
    assert infer_type(schema) == "snapshot" and infer_type(schema, cursor="id") == "cdc" and infer_type(schema, "append") == "append"
    assert infer_type(schema, dimensions=("date",)) == "cdc" and infer_type(schema, name="log", append_tables=("log",)) == "append"
    rows = table_metadata(spark, ["b", "a"], lambda n: TableMeta([n + "_id"], None, "snapshot")).collect()
    assert [(r["tableName"], r["primary_keys"]) for r in rows] == [("b", ["b_id"]), ("a", ["a_id"])]


def test_schemas():
    s = schema_from_descriptors([
        {"name": "a", "type": "long", "nullable": False}, {"name": "b", "type": "struct", "fields": [{"name": "c", "type": "boolean"}]},
        {"name": "d", "type": "array", "items": {"type": "double"}}, {"name": "e", "type": "decimal", "precision": 50, "scale": 4}, {"name": "g", "type": "geopoint"},
    ])
    assert s.simpleString() == "struct<a:bigint,b:struct<c:boolean>,d:array<double>,e:decimal(38,4),g:struct<latitude:double,longitude:double>>"
    edm = schema_from_descriptors([{"name": "x", "type": "Edm.Int64"}, {"name": "y", "type": "Edm.Decimal", "precision": 10, "scale": "variable"}, {"name": "z", "type": "Collection(Edm.String)"}], "edm")
    assert edm.simpleString() == "struct<x:bigint,y:decimal(10,5),z:string>"
    assert schema_from_header(["A b", "", None]).names == ["row_index", "A_b", "_col1", "_col2"]


def test_ingestion_resumes_and_isolates_failures(spark, folder):
    def land(rows, schema, name):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/{name}")

    schema = "id bigint, ts bigint, v string"
    land([(1, 1, "a"), (2, 2, "b")], schema, "t")
    register_transform("upper_v", lambda df: df.withColumn("v", F.upper("v")))
    spec = {"connection_name": "c", "objects": [
        {"table": {"source_table": "t", "table_configuration": {"transform": "upper_v"}}}, {"table": {"source_table": "broken"}},
        {"table": {"source_table": "s", "table_configuration": {"scd_type": "SCD_TYPE_2"}}}, {"table": {"source_table": "missing"}},
    ]}
    land([(1, "x")], "id bigint, n string", "s1")
    st = T._parse_datatype_string(schema)
    sources = {
        "t": Landed(f"{folder}/t", TableMeta(["id"], "ts", "cdc"), st), "broken": Landed(f"{folder}/none", TableMeta(["nope"], "ts", "cdc"), st),
        "s": Landed(f"{folder}/s1", TableMeta(["id"], None, "snapshot"), T._parse_datatype_string("id bigint, n string")),
    }
    run = Ingestion(spark, spec, sources, f"{folder}/out")
    out = {o.table: o.error for o in run.run()}
    assert out["t"] is None and out["s"] is None and "not in the schema" in out["broken"] and "KeyError" in out["missing"]
    assert sorted(map(tuple, run.read("t").collect())) == [(1, 1, "A"), (2, 2, "B")]
    # a later run continues from the checkpoint
    land([(1, 5, "c"), (2, 1, "old")], schema, "t")
    sources["s"] = Landed(f"{folder}/s2", sources["s"].meta, sources["s"].schema)
    land([(1, "y"), (2, "z")], "id bigint, n string", "s2")
    again = Ingestion(spark, spec, sources, f"{folder}/out")
    assert {o.table: o.error for o in again.run()}["t"] is None
    assert sorted(map(tuple, again.read("t").collect())) == [(1, 5, "C"), (2, 2, "B")]
    assert sorted(map(tuple, again.read("s").select("id", "n", "__START_AT", "__END_AT").collect()), key=str) == sorted(
        [(1, "x", 0, 1), (1, "y", 1, None), (2, "z", 1, None)], key=str
    )


def test_hierarchy_with_cycle_and_orphan(spark):
    rows = [("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x"), ("z", "x"), ("o", "gone")]
    got = {r["id"]: r for r in fm.hierarchy(spark.createDataFrame(rows, "id string, p string"), "id", "p").collect()}
    assert (got["c"]["depth"], got["c"]["path"], got["c"]["root"]) == (2, "a/b/c", "a")
    assert got["o"]["depth"] == 0 and [i for i in got if got[i]["cycle"]] == ["x", "y", "z"] or {i for i in got if got[i]["cycle"]} == {"x", "y", "z"}
    deep = [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 30)]
    far = {r["id"]: r for r in fm.hierarchy(spark.createDataFrame(deep, "id string, p string"), "id", "p").collect()}
    assert all((far[f"n{i}"]["depth"], far[f"n{i}"]["root"], far[f"n{i}"]["cycle"]) == (i, "n0", False) for i in range(30))


def test_hierarchy_joins_only_nodes_that_have_not_arrived(spark, monkeypatch):
    written = []
    keep = fm.checkpointed

    def noted(df, purpose):
        out = keep(df, purpose)
        written.append(out.count())
        return out

    monkeypatch.setattr(fm, "checkpointed", noted)
    rows = [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 20)] + [(f"l{i}", f"n{i % 20}") for i in range(500)] + [(f"u{i}", "gone") for i in range(50)]
    rows += [("twice", "n3"), ("twice", "n4"), ("twice", "gone"), (None, "n1"), ("r", "r"), ("under", "r")]
    got = [tuple(r) for r in fm.hierarchy(spark.createDataFrame(rows, "id string, p string"), "id", "p").collect()]
    path = lambda n: "/".join(f"n{i}" for i in range(n + 1))
    want = [(f"n{i}", "n0", i, path(i), False) for i in range(20)] + [(f"l{i}", "n0", i % 20 + 1, f"{path(i % 20)}/l{i}", False) for i in range(500)]
    want += [(f"u{i}", f"u{i}", 0, f"u{i}", False) for i in range(50)] + [(None,) * 5, ("r", None, None, None, True), ("under", None, None, None, True)]
    want += [("twice", "n0", n + 1, f"{path(n)}/twice", False) for n in (3, 4)] * 3  # three rows of the key, two parents that exist
    assert sorted(got, key=str) == sorted(want, key=str)
    assert written[0] == len(rows) and max(written[1:]) == 21  # the rest are no one's parents


def test_fk_names_collide():
    assert fm.fk_names([("A", ["id"]), ("A", ["id"])], ["A_id"]) == [{"id": "_A_id"}, {"id": "__A_id"}]


def test_select_rules(spark):
    df = spark.createDataFrame([(1, 2)], "id int, c int")
    for cols in (["id", "x"], ["c"], ["id"]):
        with pytest.raises(ValueError):
            sl.select_columns(df, cols, ["id"], "c")
    with pytest.raises(ValueError):
        sl.page_number(df, ["id"], 0, 5)
    assert sl.page_offset(df, ["id"], 10, 5).count() == 0
    assert sl.parse_filters_at('{"a": "x", "1": "y"}', ["a", "b", "a"]) == {0: "x", 2: "x", 1: "y"}
    with pytest.raises(ValueError):
        sl.parse_filters_at('{"q": "x"}', ["a"])
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 4)], "id int, v int")
    assert [r["id"] for r in sl.sort_nulls(rows, "v", "desc").collect()] == [2, 1, 3]
    assert [r["id"] for r in sl.sort_nulls(rows, "v").collect()] == [3, 1, 2]


def test_bins_are_balanced(spark):
    df = spark.range(9).withColumnRenamed("id", "o")
    sizes = pt.bin_contiguous(df, 4, ["o"]).groupBy("bin").count().orderBy("bin").collect()
    assert [r["count"] for r in sizes] == [3, 2, 2, 2]
    assert pt.bin_contiguous(df.limit(2), 4, ["o"]).select("bin").distinct().count() == 2
    assert pt.plan_windows(spark, None, __import__("datetime").datetime(2024, 1, 1), 1).count() == 1


def test_paths_of_deep_and_odd_documents(spark):
    """A deep row adds passes over its own nodes only; kinds of leaves, empty containers and nested lists."""
    from tidemark.operators import quality as q

    deep = '{"d":' * 40 + '{"x":1,"y":[[{"z":null}]]}' + "}" * 40
    rows = ['{"a":1,"b":{"c":"t","e":{},"l":[]},"n":null,"f":1.5,"t":true}', '{"a":"s","b":[{"c":2},{"k":{"m":1}}]}', deep, "[1,2]", "7", "not json", None, "{}"]
    df = spark.createDataFrame([(r,) for r in rows], "b string")
    got = {(r.path, r.kind) for r in q.data_paths(df, "b").collect()}
    base = ".".join(["d"] * 40)
    want = {(".".join(["d"] * k), "dict") for k in range(1, 41)}
    want |= {(base + ".x", "int"), (base + ".y", "list"), (base + ".y.z", "null")}
    want |= {("a", "int"), ("a", "str"), ("b", "dict"), ("b", "list"), ("b.c", "str"), ("b.c", "int"), ("b.e", "dict"), ("b.l", "list"), ("b.k", "dict"), ("b.k.m", "int")}
    want |= {("n", "null"), ("f", "float"), ("t", "bool")}
    assert got == want
    assert q.data_paths(df.limit(0), "b").count() == 0


def test_rows_dealt_anew_by_their_size(spark):
    from tidemark.operators import quality as q

    df = spark.createDataFrame([(i, f"{i * 7919:x}" * 5) for i in range(40_000)], "id bigint, v string").repartition(8)
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        per = q.dealt_anew(df).groupBy(F.spark_partition_id()).agg(F.count("id").alias("count"), F.max("v")).collect()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(per) > 8 and sum(r["count"] for r in per) == 40_000
    assert q.fingerprint(q.dealt_anew(df)).first() == q.fingerprint(df).first()
