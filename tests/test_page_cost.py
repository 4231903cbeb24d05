"""What page extraction may cost: pages of a small file are dealt out, expressions are evaluated once."""

from pyspark.sql import functions as F

from coursewise.functions import markup
from coursewise.plans import fixtures


def _tables(spark, root, **rows):
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")


def test_page_forms_of_one_small_file_are_parsed_by_many_tasks(spark, tmp_path):
    _tables(spark, tmp_path, part=([(k, 5, "Brand#1") for k in range(1, 400)], "p_partkey bigint, p_size int, p_brand string"))
    pages = fixtures.fx_page_forms(spark, str(tmp_path))
    assert pages.select(F.spark_partition_id()).distinct().count() > 1
    assert pages.count() == 399


def test_the_expression_of_an_element_is_evaluated_once(spark):
    page = spark.createDataFrame([('<a class="x"><b>1</b></a>',)], "html string")
    got = page.select(markup.first_element(F.col("html"), markup.opening("class", "x")).alias("x"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(html") == 1
    assert got.first().x == "<b>1</b>"


def test_elements_of_text_alone_and_others(spark):
    pages = ["<div id='a'>one</div>", '<DIV id="a" t=">">one &amp; two</div ><div>x</div>', "<div id='a'>1<div>2</div>3</div>4",
             "<div id='a'>open", "<div id='a'>1</divider>2</div>", "<div id='a'><!-- </div> -->in</div>", "<div id='a'></div>", "<p>none</p>", None]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    found = markup.first_element(F.col("html"), markup.opening("id", "a"))
    got = [r.x for r in rows.select("i", found.alias("x")).orderBy("i").collect()]
    assert got == ["one", "one &amp; two", "1<div>2</div>3", "open", "1</divider>2", "in", "", None, None]


def test_words_of_pages_are_found_in_any_case(spark):
    rows = spark.createDataFrame([("<META PROPERTY='Product:Price' CONTENT='5'>",), ("<meta>",), (None,)], "html string")
    got = rows.select(markup.if_has(F.col("html"), "product:PRICE", F.lit(1)).alias("x")).collect()
    assert [r.x for r in got] == [1, None, None]


def test_files_are_counted_before_they_are_routed(spark, tmp_path, monkeypatch):
    from coursewise.plans import registry
    from coursewise.sources import ledger

    _tables(spark, tmp_path,
            lineitem=([], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_discount double, "
                          "l_extendedprice double, l_shipdate date, l_returnflag string, l_tax double"),
            part=([(k, "p", "t", "b", 1) for k in range(50)], "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int"),
            orders=([], "o_orderkey bigint, o_orderdate date"), supplier=([], "s_suppkey bigint, s_name string, s_nationkey bigint"),
            nation=([], "n_nationkey bigint, n_name string"))
    routed, route = [], ledger.route_by_filename
    monkeypatch.setattr(ledger, "route_by_filename", lambda df: routed.append(df.count()) or route(df))
    got = {r.target: r.row_count for r in registry.QUERIES["s6_route_files"](spark, str(tmp_path)).collect()}
    assert got[None] == 50 and routed[0] < 50


def _shop(spark, root):
    rows = [(k, k % 50, 3, k % 7 + 1, float(k % 9 + 1), 100.0 + k, k % 3 / 10, k % 2 / 10) for k in range(210)]
    _tables(spark, root,
            lineitem=(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
            part=([(k, f"name {k}", "type", "Brand#1", k % 12, 10.0) for k in range(50)], "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int, p_retailprice double"))
    return str(root)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _joins(df):
    return "".join(line for line in _optimized(df).splitlines() if "Join " in line)


def test_payload_members_are_read_once_and_other_pages_left_early(spark, tmp_path):
    from coursewise.plans import registry

    df = registry.QUERIES["e12_course_records"](spark, _shop(spark, tmp_path))
    plan = _optimized(df)
    assert plan.count(", $.numStudents)") == 1
    assert plan.index("rating-number") < plan.index("isnotnull(__payload")
    assert df.count() == 105  # 30 pages each of line numbers 2, 3 and 5, 15 of line number 4 with a list price


def test_pages_are_not_parsed_in_the_join_of_a_price_merge(spark, tmp_path):
    from coursewise.plans import registry

    df = registry.QUERIES["e15_merge_price"](spark, _shop(spark, tmp_path))
    assert "regexp" not in _joins(df) and df.count() == 210


def test_pages_are_not_parsed_in_the_join_of_price_records(spark, tmp_path):
    from coursewise.plans import registry

    df = registry.QUERIES["e13_price_records"](spark, _shop(spark, tmp_path))
    assert "regexp" not in _joins(df) and df.count() == 210
