import duckdb
import pytest

from tallyloom.llm.lines import dedup_lines
from tallyloom.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def brute(rows, min_chars=10, min_docs=2):
    ws, up = " \t\n\x0b\x0c\r", {c: chr(c + 32) for c in range(65, 91)}
    key = lambda l: l.strip(ws).translate(up)
    held = {}
    for i, t in rows:
        for l in (t or "").split("\n"):
            held.setdefault(key(l), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for l in lines:
            ids = held[key(l)]
            ids_ok = [x for x in ids if x is not None]
            gone = len(key(l)) >= min_chars and len(ids) >= min_docs and i != (min(ids_ok) if ids_ok else None)
            if not gone:
                stay.append(l)
        out.append((i, "\n".join(stay) if t is not None or True else "", len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


ROWS = [
    (3, "Shared line here\nown of three\n\nShared line here  "), (1, "\tSHARED LINE HERE\nown of one"), (2, None),
    (4, ""), (5, "short\nshared line here"), (6, "short\r\n"), (1, "\tSHARED LINE HERE\nown of one"),
    (None, "shared line here\nonly nobody has this"), (7, "a" * 30000 + "\n" + "b" * 30000), (8, "A" * 30000),
    (9, "\n\n\n"), (10, "own of three\x0b"), (11, "x\nown of three\nx\nx"),
]


@pytest.mark.parametrize("n", [2, 3])
def test_against_brute_force(spark, n):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    out = dedup_lines(df, min_docs=n)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str) == brute(ROWS, min_docs=n)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS n_lines", "2 AS _lost", "3 AS _h")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "_lost", "_h", "n_lines", "n_dropped"]
    assert {(r._lost, r._h) for r in out.collect()} == {(2, 3)}
    assert dedup_lines(df.limit(0)).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    cols = "doc_id, n_lines, n_dropped, kept_sha256"
    want = con.execute(f"select {cols} from ({SQL['op9_line_dedup']}) order by 1").fetchall()
    got = QUERIES["op9_line_dedup"](spark, SMALL).select(*cols.split(", ")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want
    assert sum(r[2] for r in want) > 0
