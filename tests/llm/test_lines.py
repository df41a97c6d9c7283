"""Line dedup against a scan in Python and against its SQL."""

import duckdb
import pytest

from cohortcast.llm import lines

P = "alpha line\nbeta line\ngamma line\ndelta line"
ROWS = [(3, f"start\n{P}\nend"), (1, f"{P}\nthen other"), (2, "alpha line\nbeta line"), (4, P), (5, None), (6, ""), (7, "\n\n\n\n\n"),
        (8, "\n\n\n\nx"), (9, "a\na\na\na\na"), (10, "a\na\na"), (11, f"{P}\nq\nr\n{P}"), (12, "one"), (13, "q\nr\nalpha line"),
        (14, "é\nß\n漢\n"), (15, "é\nß\n漢\nmore"), (16, "\n".join(f"l{i}" for i in range(3000))),
        (17, "\n".join(f"l{i}" for i in range(0, 6000)))]


def brute(rows):
    first, out = {}, []
    order = sorted(((-10 ** 9 if i is None else i, t) for i, t in rows), key=lambda r: r[0])
    for i, t in order:
        ls = (t or "").split("\n")
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            first[w] = min(first.get(w, (i, p)), (i, p))
    for i, t in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        ls, gone = t.split("\n"), set()
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            if "".join(w).strip(" ") and (-10 ** 9 if i is None else i, p) > first[w]:
                gone |= {p, p + 1, p + 2}
        out.append((i, "\n".join(x for k, x in enumerate(ls) if k not in gone), len(gone)))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 9) for i, t in rows], "doc_id long, text string, pos string, removed_lines int").repartition(3)
    got = lines.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "pos", "removed_lines"]
    return sorted(((r.doc_id, r.text, r.removed_lines) for r in got.collect()), key=str)


def test_equals_brute_force_and_sql(spark):
    got = run(spark, ROWS)
    assert got == brute(ROWS)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", ROWS)
    assert sorted(con.sql(lines.ORACLE).fetchall(), key=str) == got


@pytest.mark.parametrize("extra", [[(4, P), (4, P)], [(None, P)], [(4, "other\n" + P)]])
def test_repeated_rows_and_null_ids(spark, extra):
    rows = ROWS + extra
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
