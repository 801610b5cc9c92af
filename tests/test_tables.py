import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sheaf.operators.clean import drop_empty, falsy_to_null
from sheaf.operators.dedupe import first_per_key
from sheaf.operators.filters import apply_filters
from sheaf.operators.hooks import run_hook
from sheaf.operators.joins import join_on_id
from sheaf.operators.merge import merge_lists, merged_values
from sheaf.operators.records import long, scalar_id
from sheaf.operators.serials import split_serials
from sheaf.plans.harvest import finish, harvest_files, harvest_table
from sheaf.sources import tabular
from sheaf.sources.ndjson import scan_mapping_lines, scan_ndjson
from sheaf.spec import CollectionSpec, FieldFilter, FieldSpec


def test_sequential_files(spark, tmp_path):
    for i in range(1, 6):
        (tmp_path / f"example{i}.csv").write_text("id,title\n" + "".join(f'{i}{j},"a, ""{j}"""\n' for j in range(4)))
    (tmp_path / "more.tsv").write_text("id\tnote\n1\tx,y\n2\tz\n")
    paths = [str(tmp_path / f"example{i}.csv") for i in (5, 1, 2, 3, 4)]
    table = tabular.scan_delimited(spark, paths)
    rows = table.orderBy(*tabular.FILE_ORDER).collect()
    assert len(rows) == 20
    assert [r.id for r in rows[:5]] == ["50", "51", "52", "53", "10"]
    assert rows[0].title == 'a, "0"'
    wide = tabular.scan_delimited(spark, [*paths, str(tmp_path / "more.tsv")])
    assert wide.count() == 22
    assert [r.note for r in wide.where("file_idx = 5").orderBy("file_row").collect()] == ["x,y", "z"]
    assert wide.where("title IS NULL").count() == 2


def test_json_array_keeps_text(spark, tmp_path):
    (tmp_path / "data.json").write_text('[{"id":1,"when":"2024-01-02","tags":["a"]},\n{"id":2,"when":"1888"}]')
    rows = tabular.scan_json_array(spark, str(tmp_path / "data.json")).orderBy("id").collect()
    assert [(r.id, r.when, r.tags) for r in rows] == [("1", "2024-01-02", ["a"]), ("2", "1888", None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["é", 'q"'], None), (2, None, "a\nb")], "id bigint, tags array<string>, note string")
    tabular.write_csv(df, str(tmp_path / "c"))
    rows = tabular.scan_csv(spark, str(tmp_path / "c")).orderBy("id").collect()
    assert rows[0].tags == '["é","q\\""]' and rows[1].note == "a\nb"
    tabular.write_json(df, str(tmp_path / "j"))
    lines = [r.value for r in scan_ndjson(spark, str(tmp_path / "j")).orderBy("value").collect()]
    assert lines[0] == '{"id":1,"tags":["é","q\\""],"note":null}'


def test_blank_lines_and_line_numbers(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"a":1}\n\n  \t\n{"a":2}\n')
    assert scan_ndjson(spark, str(tmp_path / "a.ndjson")).count() == 2
    (tmp_path / "m.rb").write_text("one\ntwo\r\nthree")
    rows = scan_mapping_lines(spark, str(tmp_path / "m.rb")).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in rows] == [(0, "one"), (1, "two"), (2, "three")]


def test_include_and_exclude(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"]), (None, None), ("c", [])], "c string, l array<string>")
    ids = lambda d: sorted(str(r.c) for r in d.collect())
    assert ids(apply_filters(df, {})) == ["None", "a", "b", "c"]
    assert ids(apply_filters(df, {"c": FieldFilter(include=("a", "b"))})) == ["a", "b"]
    assert ids(apply_filters(df, {"c": FieldFilter(exclude=("a",))})) == ["None", "b", "c"]
    assert ids(apply_filters(df, {"l": FieldFilter(exclude=("x", "y"))})) == ["None", "b", "c"]
    assert ids(apply_filters(df, {"l": FieldFilter(include=("y", "q"))})) == ["a"]
    assert ids(apply_filters(df, {"c": FieldFilter(include=("a", "b")), "l": FieldFilter(exclude=("x", "y"))})) == ["b"]
    once = apply_filters(df, {"c": FieldFilter(exclude=("a",))})
    assert ids(apply_filters(once, {"c": FieldFilter(exclude=("a",))})) == ids(once)


def test_falsy(spark):
    df = spark.createDataFrame([("", 0, False, []), ("a", 2, True, ["x"])], "s string, n int, b boolean, l array<string>")
    rows = falsy_to_null(df).collect()
    assert tuple(rows[0]) == (None, None, None, None)
    assert tuple(rows[1]) == ("a", 2, True, ["x"])
    assert drop_empty(df, ["s", "n", "b", "l"]).count() == 1


def test_first_record_wins_also_for_null_ids(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), (None, 4, "n2"), (None, 3, "n1")], "id string, seq int, v string")
    out = first_per_key(df, ["id"], ["seq"])
    assert {(r.id, r.v) for r in out.collect()} == {("a", "first"), (None, "n1")}
    assert first_per_key(out, ["id"], ["seq"]).count() == out.count()


def test_list_id_becomes_its_first_value(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "id array<string>")
    assert [r.id for r in scalar_id(df, "id").collect()] == ["a", None, None]


def merge_rows(spark, rows):
    return spark.createDataFrame(rows, "seq int, id string, shelf array<string>, title array<string>, subject array<string>")


def test_merge_language_versions(spark):
    df = merge_rows(spark, [
        (1, "id2", ["X 1"], ["ar"], None), (0, "id1", ["X 1", "Y"], ["en 1", "en 2"], ["s"]), (2, "id3", ["Z"], ["t"], []),
    ])
    out = {r.locator: r for r in merge_lists(df, "shelf", "id", ["seq"], ["title", "subject"]).collect()}
    assert (out["X 1"].id, out["X 1"].title, out["X 1"].subject) == ("id1", ["en 1", "en 2", "ar"], ["s"])
    assert (out["Z"].id, out["Z"].title, out["Z"].subject) == ("id3", ["t"], [])


def test_merge_of_a_large_group_has_the_usual_shape(spark):
    df = merge_rows(spark, [(i, f"i{i}", ["hot"], [f"t{i}", "u"], None) for i in range(25)] + [(99, "z", ["cold"], ["c"], None)])
    rows = merge_lists(df, "shelf", "id", ["seq"], ["title"]).collect()
    wide = {r.locator: (r.id, r.title) for r in rows}
    assert wide == {"hot": ("i0", [t for i in range(25) for t in (f"t{i}", "u")]), "cold": ("z", ["c"])}
    long = merged_values(df, "shelf", "id", ["seq"], ["title", "subject"]).orderBy("locator", "column", "seq", "item").collect()
    assert [(r.id, r.value) for r in long if r.locator == "hot"] == [("i0", t) for t in wide["hot"][1]]
    assert {r.column for r in long} == {"title"}


def test_a_merged_list_of_any_size_comes_in_parts(spark):
    rows = [(i // 2, f"i{i:03}", ["hot"], [f"t{i}", None, f"u{i}"][: i % 4], [f"s{i}"] if i % 50 == 0 else None) for i in range(400)]
    rows += [(7, "z", ["cold"], ["c"], []), (8, "e", ["empty"], None, []), (9, "n", None, ["x"], None), (3, "n2", [], ["y"], None)]
    df = merge_rows(spark, rows).repartition(7)
    wanted = {}
    for seq, key, shelf, title, subject in sorted(rows, key=lambda r: (r[0], [("", x)[x is not None] for x in r[3] or []])):
        held = wanted.setdefault(shelf[0] if shelf else None, [[], []])
        held[0] += title or []
        held[1] += subject or []
    for size in (1, 7, 10_000):
        got, parts = {}, {}
        for r in sorted(merge_lists(df, "shelf", "id", ["seq"], ["title", "subject"], part_items=size).collect(), key=lambda r: r.part):
            held = got.setdefault(r.locator, [[], []])
            parts.setdefault(r.locator, []).append((r.part, len(r.title)))
            held[0] += r.title
            held[1] += r.subject
            assert max(len(r.title), len(r.subject)) <= size
        assert {k: sorted(map(str, v[0])) for k, v in got.items()} == {k: sorted(map(str, v[0])) for k, v in wanted.items()}
        assert got["hot"][1] == wanted["hot"][1] and got[None][0] == ["y", "x"] and got["empty"] == [[], []]
        assert all(n == size for _, n in parts["hot"][:-1]) and [p for p, _ in parts["hot"]] == list(range(len(parts["hot"])))
    order = [t for t in got["hot"][0] if t and t.startswith("u")]
    assert order == sorted(order, key=lambda t: int(t[1:]))


def test_merge_moves_no_locator_into_one_task(spark):
    """Windows run over a range's rows, or over the sums of ranges; lists are gathered by part."""
    text = plan(merge_lists(merge_rows(spark, [(1, "a", ["x"], ["t"], None)]), "shelf", "id", ["seq"], ["title"]))
    rows = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
    assert rows and all("_range" in line or "_groupingexpression" in line for line in rows if "locator" in line), rows


def test_parts_of_a_large_locator_are_joined_with_its_first_id_where_they_lie(spark):
    """The first ids are the small side, whatever the parts' size; where they are large too, parts are the side Spark can split."""
    rows = [(i, f"i{i}", ["hot"], [f"t{i}", "u"], None) for i in range(3000)]
    rows += [(1, "e", ["bare"], None, []), (0, "f", ["bare"], None, None), (2, "n", [], ["y"], None)]
    df, usual = merge_rows(spark, rows).repartition(7), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("4k", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            merged = merge_lists(df, "shelf", "id", ["seq"], ["title", "subject"], part_items=100)
            text = plan(merged)
            assert "Outer" not in text
            if threshold == "4k":
                dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]
                assert dealt and all("_range" in line or "_groupingexpression" in line for line in dealt), dealt
            got = merged.collect()
            assert sorted((r.part, r.id, len(r.title)) for r in got if r.locator == "hot") == [(i, "i0", 100) for i in range(60)]
            assert sorted((str(r.locator), r.id, r.part, r.title, r.subject) for r in got if r.locator != "hot") == [
                ("None", "n", 0, ["y"], []), ("bare", "f", 0, [], []),
            ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_long_form_deals_no_rows_out_by_locator(spark):
    """The first ids have a known size before the join; a plan that learns it on the way has moved the rows by then."""
    rows = [(i, f"i{i}", ["hot"], [f"t{i}", "u"], None) for i in range(3000)] + [(5, "n", [], ["y"], None), (4, "m", None, None, ["s"])]
    df, usual = merge_rows(spark, rows).repartition(7), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
        long = merged_values(df, "shelf", "id", ["seq"], ["title", "subject"])
        assert "Exchange hashpartitioning(" not in plan(long) and "BroadcastHashJoin" in plan(long)
        got = long.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert long.columns == ["locator", "id", "column", "seq", "item", "value"]
    assert sorted(tuple(r)[1:] for r in got if r.locator) == sorted(("i0", "title", i, j, v) for i in range(3000) for j, v in enumerate((f"t{i}", "u")))
    assert sorted(tuple(r)[1:] for r in got if not r.locator) == [("m", "subject", 4, 0, "s"), ("m", "title", 5, 0, "y")]


def test_split_serials(spark):
    fields = [{"001": "x"}, {"974": "v1"}, {"245": "t"}, {"974": "v2"}]
    df = spark.createDataFrame([("l1", fields), ("l2", [{"001": "y"}])], "leader string, fields array<map<string,string>>")
    rows = split_serials(df).orderBy("issue_no").collect()
    assert [r.fields for r in rows] == [[{"001": "x"}, {"245": "t"}, {"974": v}] for v in ("v1", "v2")]
    assert {r.leader for r in rows} == {"l1"}


def test_join_renames_shared_columns(spark):
    a = spark.createDataFrame([("1", "l"), ("2", "m")], "id string, thumbnail string")
    b = spark.createDataFrame([("1", "r", 5)], "id string, thumbnail string, n int")
    out = join_on_id(a, b)
    assert out.columns == ["id", "thumbnail_x", "thumbnail_y", "n"]
    assert [tuple(r) for r in out.collect()] == [("1", "l", "r", 5)]


def test_dotted_columns(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'c d', named_struct('e', 'x')) AS a, 2 AS f")
    assert tabular.dotted(df).columns == ["a.b", "a.c d.e", "f"]


def test_hooks(spark):
    df = spark.range(1)
    assert run_hook(df, CollectionSpec("c", "xml")) is df
    with pytest.raises(ValueError):
        run_hook(df, CollectionSpec("c", "xml", post_harvest="unknown"))


def test_spec_from_dict():
    raw = {
        "driver": "oai_xml",
        "args": {"metadata_prefix": "mods", "full_harvest": True},
        "metadata": {
            "record_count_formula": "/2",
            "fields": {"id": {"path": "//i", "name_in_dataframe": "Record ID"}, "t": {"path": "//t", "optional": "false"}},
            "filters": {"c": {"include": ["x"]}},
        },
    }
    spec = CollectionSpec.from_dict("c", raw)
    assert spec.id_column == "Record ID" and spec.full_harvest and spec.fields["t"].optional is False
    assert spec.filters["c"].include == ("x",)
    assert CollectionSpec("d", "xml").id_column == "id"


def test_whole_harvest(payloads):
    pages = payloads('{"r":[{"id":"1","k":["x"]},{"id":"2","k":["y"]}]}', '{"r":[{"id":"1","k":["late"]},{"id":"3","k":["x","z"]}]}')
    spec = CollectionSpec(
        "c", "custom_json", {"id": FieldSpec("id"), "k": FieldSpec("k")}, "r", filters={"k": FieldFilter(exclude=("y",))}
    )
    out = harvest_table(pages, spec, ["id", "k"])
    assert {(r.id, tuple(r.k)) for r in out.collect()} == {("1", ("x",)), ("3", ("x", "z"))}


def test_table_files_by_spec(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,c\n1,x\n2,y\n1,late\n")
    (tmp_path / "b.csv").write_text("id,c,d\n2,later,d\n3,x,d\n")
    raw = {"driver": "sequential_csv", "args": {"urlpath": [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]},
           "metadata": {"fields": {"id": {"path": "id"}}, "filters": {"c": {"exclude": ["y"]}}}}
    out = harvest_files(spark, CollectionSpec.from_dict("t", raw))
    assert {(r.id, r.c, r.d) for r in out.collect()} == {("1", "x", None), ("3", "x", "d")}
    limited = harvest_files(spark, CollectionSpec.from_dict("t", {**raw, "metadata": {**raw["metadata"], "record_limit": 4}}))
    assert {r.id for r in limited.collect()} == {"1"}


def test_harvests_do_not_share_ids(payloads):
    body = '{"r":[{"id":"1","k":["x"]},{"id":"1","k":["y"]},{"id":"2","k":["z"]}]}'
    both = payloads(body, harvest="a").unionByName(payloads(body, harvest="b"))
    fields = {"id": FieldSpec("id"), "k": FieldSpec("k")}
    out = harvest_table(both, CollectionSpec("c", "custom_json", fields, "r"), ["id", "k"])
    assert {(r.harvest_id, r.id, tuple(r.k)) for r in out.collect()} == {(h, i, (k,)) for h in "ab" for i, k in (("1", "x"), ("2", "z"))}
    limited = harvest_table(both, CollectionSpec("c", "custom_json", fields, "r", record_limit=2), ["id", "k"])
    assert {(r.harvest_id, r.id) for r in limited.collect()} == {("a", "1"), ("b", "1")}


def test_hook_runs_last(payloads):
    pages = payloads('{"r":[{"id":"1","k":["x"],"t":["a"]},{"id":"2","k":["x"],"t":["b"]}]}')
    fields = {"id": FieldSpec("id"), "k": FieldSpec("k"), "t": FieldSpec("t")}
    spec = CollectionSpec("c", "custom_json", fields, "r", post_harvest="merge_records")
    arguments = {"locator": "k", "id_column": "id", "order": ["seq", "pos"], "list_columns": ["t"], "within": ("harvest_id",)}
    (row,) = harvest_table(pages, spec, ["id", "k", "t"], arguments).collect()
    assert (row.harvest_id, row.locator, row.id, row.t) == ("h", "x", "1", ["a", "b"])


def test_filter_comes_after_dedupe(spark):
    df = spark.createDataFrame([(0, 0, "a", "drop"), (1, 0, "a", "keep")], "seq int, pos int, id string, c string")
    spec = CollectionSpec("c", "custom_json", filters={"c": FieldFilter(exclude=("drop",))})
    assert finish(df, spec).count() == 0


def test_long_form(spark):
    df = spark.sql("SELECT 1 AS k, map('a', array('x', 'y'), 'b', array('z')) AS fields")
    assert sorted((r.field, r.vpos, r.value) for r in long(df, ["k"]).collect()) == [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([("hot", i) for i in range(10)], "id string, seq int")
    text = plan(first_per_key(df, ["id"], ["seq"]))
    below_exchange = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(5).selectExpr("cast(id as string) AS a", "id AS b", "id AS c").write.parquet(str(tmp_path / "p"))
    df = apply_filters(spark.read.parquet(str(tmp_path / "p")), {"a": FieldFilter(include=("1",))}).select("b")
    text = plan(df)
    assert "EqualTo(a,1)" in text or "In(a" in text
    assert "ReadSchema: struct<a:string,b:bigint>" in text


def test_body_is_parsed_once(spark, payloads):
    from sheaf.sources.manifests import manifest_records

    text = plan(manifest_records(payloads("{}"), CollectionSpec("c", "iiif_json", {"id": FieldSpec("@id"), "t": FieldSpec("a.b")})))
    assert text.count("ParseJson") + text.count("parse_json") <= 2 and "from_json" in text
    assert text.count("from_json(") == 1


def test_truthiness_needs_no_shuffle(spark):
    assert "Exchange" not in plan(drop_empty(spark.range(3).select(F.col("id")), ["id"]))


def test_page_bodies_do_not_move(payloads):
    from sheaf.operators.paging import until_malformed

    text = plan(until_malformed(payloads("<r/>", "x")))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["json_descend", "manifest_records", "xml_records", "oai_records", "oai_all_leaves", "oai_marc_records"])
def test_extraction_needs_no_python(spark, name):
    """Executors need nothing but Spark: no step of an extraction leaves the JVM."""
    from sheaf.plans import extract_queries
    from sheaf.plans.catalogue import QUERIES

    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert extract_queries and not any(word in text for word in ("Python", "Pandas", "InArrow"))


def test_a_cluster_needs_a_shared_folder(spark, tmp_path):
    from types import SimpleNamespace

    from sheaf.session import shared_dir

    def session(master, folder):
        settings = {"spark.checkpoint.dir": folder} if folder else {}
        return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077", None), "x")
    assert shared_dir(session("spark://host:7077", str(tmp_path)), "x").startswith(f"{tmp_path}/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
