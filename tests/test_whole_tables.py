"""Registered queries work on every row of their tables."""

from millrace.plans import queries as plans
from millrace.sources import structured


def put(spark, top, **tables):
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).write.parquet(f"{top}/{name}.parquet")
    return str(top)


def test_wide_tables_have_every_order(spark, tmp_path):
    n = 40
    keys = [k * 400 + 1 for k in range(n)]  # four lots; none divides by 50
    d = put(
        spark,
        tmp_path,
        orders=([(k, k % 3, "FO"[i % 2], "1-URGENT") for i, k in enumerate(keys)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        customer=([(c, f"c{c}", 7, "AUTO") for c in range(3)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        nation=([(7, "PERU", 1)], "n_nationkey int, n_name string, n_regionkey int"),
    )
    got = {(r.source_id, r.block_id): r.content for r in plans.wide_table_transpose(spark, d).collect()}
    assert len(got) == n
    for status in "FO":
        for i, k in enumerate((k for j, k in enumerate(keys) if "FO"[j % 2] == status), 1):
            assert got[status, i].startswith(f"**Record {i}**\n- o_orderkey: {k}\n") and got[status, i].endswith("\n- col12: z")


def test_record_blocks_equal_table_blocks(spark):
    body = [[f" {i} " if i % 3 else "", "x"][: 1 + i % 2] if i % 7 else [" ", ""] for i in range(30)]
    head = [f" h{j} " if j else "" for j in range(14)]
    whole = structured.table_blocks(spark.createDataFrame([("s", [head, *body])], "source_id string, rows array<array<string>>")).where("block_id > 0")
    parts = structured.record_blocks(spark.createDataFrame([("s", head, i, r) for i, r in enumerate(body)], "source_id string, head array<string>, i int, row array<string>"))
    columns = ("block_id", "content", "metadata")
    assert whole.select(*columns).orderBy("block_id").collect() == parts.select(*columns).orderBy("block_id").collect()


def test_merged_cells_of_every_order_are_filled(spark, tmp_path):
    lines = [(k, n, 100 * k + n) for k in (1, 39, 40, 41) for n in (1, 2, 3, 4)]
    d = put(spark, tmp_path, lineitem=(lines, "l_orderkey long, l_linenumber int, l_partkey long"))
    got = {(int(r.source_id), r.row, r.col): r.value for r in plans.merged_cell_expand(spark, d).collect()}
    own = lambda p, n, c: f"{p}:{c}" if (n + c) % 3 != 1 else None
    assert got == {(k, n, c): own(100 * k + 1, 1, 1) if n <= 3 and c <= 2 else own(p, n, c) for k, n, p in lines for c in (1, 2, 3)}


def test_ocr_blocks_of_every_document(spark, tmp_path):
    d = put(spark, tmp_path, documents=([(i, f"Title {i}\nA sentence {i}.") for i in range(7)], "doc_id long, text string"))
    got = {(int(r.source_id), r.block_id, r.type) for r in plans.ocr_headings(spark, d).collect()}
    assert got == {(i, b, kind) for i in range(7) for b, kind in enumerate(("heading", "paragraph"))}
