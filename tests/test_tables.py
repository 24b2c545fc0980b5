"""Bronze appends, sources, sinks, pages and the price list."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from checks import views
from tasador import schemas
from tasador.operators import bronze as B
from tasador.plans import pricelist as P
from tasador.sources import bucketed, pages, sinks, sites, tables


def batch(spark, rows):
    return spark.createDataFrame(rows, "Marca string, Modelo string, Precio string, Financiado string, Provincia string, AnyoMatriculacion string, Kms string, ExtractedDate date, Web string")


OLD = [("Audi", "A3", "1", "n", "p", "2019", "5", dt.date(2024, 5, 1), "w")]
NEW = [("Audi", "A3", "1", "n", "p", "2019", "5", dt.date(2024, 5, 9), "z"), ("Kia", None, "1", "n", "p", "2019", "5", dt.date(2024, 5, 9), "z")]


def test_append_keeps_the_first_sighting(spark):
    out = B.append_batch(batch(spark, OLD).drop("Web"), batch(spark, NEW))
    assert sorted((r.Marca, r.ExtractedDate.day, r.Web) for r in out.collect()) == [("Audi", 1, None), ("Kia", 9, "z")]
    again = B.append_batch(out, batch(spark, NEW))
    assert again.exceptAll(out).count() == 0


def test_guards(spark):
    with pytest.raises(B.EmptyBatch):
        B.require_rows(batch(spark, NEW))
    with pytest.raises(B.EmptyBatch):
        B.with_fallback(batch(spark, OLD), batch(spark, NEW).limit(0))
    assert B.with_fallback(batch(spark, OLD * 3), batch(spark, NEW).limit(0)).count() == 3
    fresh = B.freshness(batch(spark, OLD), batch(spark, NEW), "2024-05-16 00:00:00").first()
    assert (fresh.rows_before, fresh.rows_after, fresh.new_rows, fresh.stale) == (1, 2, 1, False)
    with pytest.raises(B.StaleTable):
        B.require_fresh(B.freshness(batch(spark, OLD), batch(spark, NEW), "2024-05-17 00:00:00"))


def test_missing_table_is_empty(spark):
    assert tables.read_or_empty(spark, "tb_nothing_task", schemas.BRONZE).count() == 0


def test_settings_and_jdbc_options(spark, tmp_path):
    path = tmp_path / "settings.json"
    path.write_text(json.dumps({"host": "h", "port": "5432", "database": "d", "user": "u"}, indent=1))
    settings = tables.read_settings(spark, str(path))
    url, properties = sinks.jdbc_options(settings, {"TASADOR_JDBC_PASSWORD": "secret"})
    assert url == "jdbc:postgresql://h:5432/d"
    assert properties["user"] == "u" and properties["password"] == "secret" and properties["batchsize"] == "10000"
    with pytest.raises(KeyError):
        sinks.jdbc_options(settings, {})


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    folder = str(tmp_path / "t")
    sinks.overwrite(spark.range(3).withColumn("old", F.lit(1)), folder)
    sinks.overwrite_growing(sinks.read_current(spark, folder).select("id").withColumn("new", F.lit(2)), folder)
    out = sinks.read_current(spark, folder)
    assert out.columns == ["id", "old", "new"] and out.count() == 3
    (tmp_path / "t" / "v9").mkdir()
    assert sinks.versions(spark, folder) == [1, 2]
    assert sinks.overwrite(out, folder).endswith("v10")


def test_nodes_of_a_page(spark):
    html = '<div class="c"><dl><dt>Año<dd>2019<dt>Caja</dt><dd> Manual &amp; x</dd></dl><script>var a="<p>";</script><a href="/u">t<b>b</b></a><br>'
    df = spark.createDataFrame([(1, "u", html), (2, None, None)], "page_id bigint, url string, html string")
    parsed = pages.page_nodes(df, ["dt", "dd", "a", "div"])
    assert parsed.columns == ["page_id", "url", "nodes"]
    first, empty = parsed.orderBy("page_id").collect()
    assert (first.url, empty.url, empty.nodes) == ("u", None, [])
    got = [tuple(n) for n in first.nodes]
    assert got[1:] == [("dt", None, "Año", None), ("dd", None, "2019", None), ("dt", None, "Caja", None), ("dd", None, "Manual & x", None), ("a", None, "tb", "/u")]
    assert got[0][1] == "c"
    terms = parsed.orderBy("page_id").select(pages.term_values(parsed["nodes"]).alias("t"), pages.first_text(parsed["nodes"], "a").alias("a"))
    assert [tuple(r) for r in terms.collect()] == [({"Año": "2019", "Caja": "Manual & x"}, "tb"), ({}, None)]


def test_pages_are_parsed_once_and_do_not_move(spark):
    df = spark.createDataFrame([(1, "<dl><dt>a<dd>b<dt>a<dd>c</dl>")], "page_id bigint, html string")
    parsed = pages.page_nodes(df, ["dt", "dd"])
    out = parsed.select("page_id", pages.term_values(parsed["nodes"]).alias("t"), pages.first_text(parsed["nodes"], "dt").alias("a"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    assert out.first()["t"] == {"a": "b"}


def test_site_rows_fit_the_bronze_table(spark):
    text = "Marca:\nAudi\nModelo:\nSerie\nVersión:\nA3 x\nKilómetros:\n45.000\nPrecio:\n12.500 €\nCombustible:\nEléctrico\nCambio:\nManual\nPotencia(CV):\n115\nAño Desde:\n2019"
    df = spark.createDataFrame([(text, "l"), ("Marca:\nAudi", "l")], "text string, link string")
    (row,) = sites.km0(df, "2024-06-03 09:07:00").collect()
    assert (row.Modelo, row.Kms, row.Precio, row.Combustible, row.AnyoMatriculacion) == ("A3", "45000", "12500", "Electrico/hibrido", "2019")
    assert row.Publicacion == "2024-06-03" and set(row.asDict()) < set(schemas.BRONZE.names)


RAW = [
    (1, "VOLVO", "V 40 x", "2015-2019", "G", "100", "1.5"),
    (2, "VOLVO", "V x", "2018-", "D", None, "2"),
    (3, "ALFA-ROMEO", "ALFA 147 jtd", "2018-nan", "GyE", "100", "3"),
    (4, "LAND", "Range Rover Evoque hse plus", "nan-nan", "S", "100", "4"),
    (5, "BMW", "X M competition", "2012", "ELC", "100", "5"),
    (6, "MAZDA", "MAZDA 3", "2001-2004", "G", "100", "6"),
    (7, "SEAT", "León", "2015-2019", "??", "100", "7"),
    (8, "MAZDA", "MAZDA 3 sedan", "2015-2019", "CNG", "x", "7"),
]


def test_price_list(spark):
    raw = spark.createDataFrame(RAW, "seq int, Marca string, Modelo string, Matriculacion string, Combustible string, Cilindrada_CV string, Precios string")
    segments = spark.createDataFrame([("MAZDA", "MAZDA3", "A")], "Marca string, Modelo_Cube string, Segmento string")
    full, known = P.build_price_list(raw, segments, "2024-06-01 00:00:00", ("seq",))
    got = {r.seq: (r.Model, r.Features, r.StarDate, r.EndDate, r.Fuel, r.CV) for r in full.collect()}
    assert got == {
        1: ("V40", "x", 2015, 2019, "GASOLINA", 100),
        2: ("V", "-", 2018, 2024, "DIESEL", 0),
        3: ("147", "jtd", 2018, 2024, "ELECTRICO/HIBRIDO", 100),
        4: ("RANGEROVEREVOQUE", "hse plus", 2024, 2024, "GLP", 100),
        5: ("XM", "competition", 2012, 2024, "ELECTRICO/HIBRIDO", 100),
        8: ("MAZDA3", "sedan", 2015, 2019, "GLP", 0),
    }
    assert [r.seq for r in known.collect()] == [8]
    assert [(f.name, f.dataType) for f in full.drop("seq").schema] == [(f.name, f.dataType) for f in schemas.PRICE_LIST]


def test_stream_appends_each_file_once(spark, tmp_path):
    from tasador.streaming.bronze import append_files

    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    full = sites.stamp(batch(spark, NEW).drop("Web"), "z", "2024-06-03 09:07:00")
    typed = full.select(*[(F.col(f.name) if f.name in full.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.BRONZE])
    for rows in (typed, typed.limit(1)):
        rows.write.mode("append").parquet(source)
        append_files(spark, source, table, state).awaitTermination()
    # The second file holds nothing new, so nothing is written.
    assert sinks.versions(spark, f"{table}/versions") == [1]
    assert bucketed.read(spark, table).count() == 2


def many(spark, numbers, day, web="w"):
    return batch(spark, [(f"Brand {i}", "m", "1", "n", "p", "2019", "5", dt.date(2024, 5, day), web) for i in numbers])


def test_buckets_a_batch_does_not_change_keep_their_files(spark, tmp_path):
    table = str(tmp_path / "listings")
    assert bucketed.read(spark, table).count() == 0
    assert bucketed.append(many(spark, range(200), 10), table, buckets=8) == list(range(8))
    before = bucketed.paths(spark, table)
    # Later sightings and a replay change nothing; a new key and an earlier sighting change their buckets.
    assert bucketed.append(many(spark, range(200), 12, "later"), table) == []
    assert bucketed.append(many(spark, range(200), 10), table) == []
    assert sinks.versions(spark, f"{table}/versions") == [1]
    late = many(spark, [7], 3, "earlier").unionByName(many(spark, [999], 11)).unionByName(many(spark, range(50), 12, "later"))
    touched = bucketed.append(late, table)
    after = bucketed.paths(spark, table)
    assert 1 <= len(touched) <= 2 and {b for b in after if after[b] != before[b]} == set(touched)
    rows = {r.Marca: (r.ExtractedDate.day, r.Web) for r in bucketed.read(spark, table).collect()}
    assert len(rows) == 201 and rows["Brand 7"] == (3, "earlier") and rows["Brand 999"] == (11, "w") and rows["Brand 8"] == (10, "w")
    assert bucketed.append(late, table) == []
    want = B.append_batch(B.append_batch(many(spark, range(200), 10), late), many(spark, [], 1))
    assert {(r.Marca, r.Web) for r in want.collect()} == {(k, w) for k, (_, w) in rows.items()}


def test_bucketed_table_edges(spark, tmp_path):
    """Null keys and dates, rows that repeat or differ only outside the key, columns that come later, empty batches, old versions."""
    table = str(tmp_path / "listings")
    assert bucketed.append(batch(spark, []), table, buckets=4) == []
    odd = batch(spark, [(None,) * 9, (None,) * 9, ("Kia", None, "1", "n", "p", "2019", "5", None, "b"), ("Kia", None, "1", "n", "p", "2019", "5", dt.date(2024, 5, 1), "a")])
    bucketed.append(odd, table, buckets=4)
    assert sorted((r.Marca or "", r.Web or "", r.ExtractedDate) for r in bucketed.read(spark, table).collect()) == [("", "", None), ("Kia", "b", None)]
    # Of two sightings of one day the smaller row stays, whichever came first.
    for web in ("m", "k", "z"):
        bucketed.append(many(spark, [1], 4, web), table)
    grown = many(spark, range(2, 40), 4).withColumn("Extra", F.lit(1))
    bucketed.append(grown, table)
    rows = bucketed.read(spark, table)
    assert rows.filter("Marca = 'Brand 1'").first().Web == "k"
    assert rows.filter("Extra = 1").count() == 38 and rows.filter("Extra is null").count() == 3
    bucketed.forget(spark, table, keep=1)
    assert len(sinks.versions(spark, f"{table}/versions")) == 1 and bucketed.read(spark, table).count() == 41


def test_typed_rows(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    rows = [(1, 2.5, "x"), (None, None, None)]
    assert [tuple(r) for r in tables.typed_rows(spark, rows, schema).collect()] == rows
    frame = spark.createDataFrame([("1", "2.5", 7), ("no", None, 8)], "a string, b string, d int")
    got = tables.typed_rows(spark, frame, schema)
    assert got.schema == schema and [tuple(r) for r in got.collect()] == [(1, 2.5, None), (None, None, None)]


def test_buckets_compare_only_the_rows_a_batch_may_replace(spark, tmp_path):
    """Many batches over the same keys give the rows of one append, and no wide row is checkpointed."""
    day = lambda d: dt.date(2024, 6, d)
    base = dict.fromkeys(schemas.BRONZE.names)

    def rows(picked):
        return spark.createDataFrame([tuple({**base, "Marca": f"m{i}", "Kms": "1", "Web": web, "ExtractedDate": d}.values()) for i, web, d in picked], schemas.BRONZE)

    batches = [
        rows([(i, "b", day(5)) for i in range(40)]),
        rows([(i, "a", day(5)) for i in range(5)] + [(i, "c", day(9)) for i in range(5, 10)] + [(i, "z", day(1)) for i in range(10, 15)] + [(99, "n", day(1))]),
        rows([(3, "q", None), (41, "n", day(2))]),
    ]
    table, whole, stored = str(tmp_path / "t"), batches[0], []
    for batch in batches[1:]:
        whole = B.union_batches(whole, batch)
    keep = bucketed.cut_lineage
    bucketed.cut_lineage = lambda df: stored.append(df.columns) or keep(df)
    try:
        for batch in batches:
            bucketed.append(batch, table, buckets=4)
    finally:
        bucketed.cut_lineage = keep
    assert all("Web" not in columns for columns in stored)
    assert sorted(map(str, bucketed.read(spark, table).collect())) == sorted(map(str, B.key_distinct(whole).select(*schemas.BRONZE.names).collect()))


def test_views_do_not_broadcast_tables_of_many_rows(spark, tmp_path, monkeypatch):
    """Files of a few bytes a row pass for small ones; a table past the bound is shuffled, and the rows are the same."""
    spark.range(3000).selectExpr("id AS l_orderkey", "id % 70 AS l_partkey", "id * 1.5E0 AS l_extendedprice", "CAST(id % 50 AS DOUBLE) AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(60).selectExpr("IF(id = 7, NULL, id % 50) AS p_partkey", "concat('Brand#1', id % 9) AS p_brand").write.parquet(f"{tmp_path}/part.parquet")

    def rows_and_plan():
        df = views.view(spark, str(tmp_path), "scored")
        return sorted(map(str, df.collect())), df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()

    want, small = rows_and_plan()
    monkeypatch.setattr(views, "BROADCAST_ROWS", 59)
    got, large = rows_and_plan()
    assert got == want and len(want) > 1000
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large and "ShuffledHashJoin" in large


def test_a_batch_is_merged_in_rounds_and_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    """Rounds of few rows give the rows of one round, and the stored batch goes with them."""
    from pathlib import Path

    from tasador.session import shared_dir

    def stored():
        return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("batch-*")}

    batches = [many(spark, range(300), 10), many(spark, range(200, 500), 10, "v").unionByName(many(spark, range(20), 12)), many(spark, range(0, 600, 7), 3, "e")]
    table, whole, before = str(tmp_path / "t"), batches[0], stored()
    for later in batches[1:]:
        whole = B.union_batches(whole, later)
    monkeypatch.setattr(bucketed, "ROWS_PER_ROUND", 250, raising=False)
    monkeypatch.setattr(bucketed, "ROWS_PER_FILE", 40, raising=False)
    for later in batches:
        bucketed.append(later, table, buckets=8)
    got = bucketed.read(spark, table).select(*batch(spark, []).columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, B.key_distinct(whole).collect()))
    assert bucketed.append(batches[2], table) == []
    assert stored() == before


def test_a_table_whose_list_has_no_width_keeps_its_keys(spark, tmp_path, monkeypatch):
    """Tables written with whole digests go on with them."""
    table = str(tmp_path / "t")
    monkeypatch.setattr(bucketed, "_WIDTH", 32)
    bucketed.append(many(spark, range(30), 10), table, buckets=4)
    monkeypatch.undo()
    sinks.overwrite(sinks.read_current(spark, f"{table}/versions").drop("width"), f"{table}/versions")
    assert bucketed.append(many(spark, range(30), 10), table) == []
    bucketed.append(many(spark, range(25, 40), 10, "v"), table)
    assert sorted(r.Marca for r in bucketed.read(spark, table).collect()) == sorted(f"Brand {i}" for i in range(40))
