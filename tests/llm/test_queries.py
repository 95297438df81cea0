"""The registered queries against their SQL, on the given tables and on planted ones."""

import random

import duckdb
import pytest

from lodewatch.llm import queries
from texts import BSD, GPL, MIT

TABLES = ("documents", "benchmark", "labels", "conversations")


def rows_of(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in values)


def both(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet{'' if folder.startswith('/root') else '/*.parquet'}'")
    df = queries.queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(queries.oracle_sql()[name])
    return got, rows_of([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    got, want = both(spark, "/root/testdata/sf0.001", name)
    assert got == want


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents with wrapped licences, banners of small and large hosts, and tokens of one, a few and many owners."""
    r, folder = random.Random(6), str(tmp_path_factory.mktemp("planted"))
    rows = []
    for i in range(600):
        parts = [" ".join(f"w{r.randint(0, 3000)}" for _ in range(r.randint(5, 40))) for _ in range(r.randint(1, 5))]
        parts += [x for x, n in ((MIT, 23), (GPL, 29), (BSD, 31), ("token=changeme77", 7), ("token=team55", 97), ("A Banner of the host", 4), ("key " + "aB3d" * 80, 150)) if i % n == 3]
        if i % 11 == 5:
            parts.append(f"key Live{i}abcXYZ{r.randint(10**9, 10**10)} ok")
        rows.append((i, "\n\n".join(parts), "en", f"s{i % 13}" if i % 3 else "hot"))
    spark.createDataFrame([*rows, (1000, None, None, None), (1001, "", "en", "s1")], "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    for t in TABLES[1:]:
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.mark.parametrize("name,column,least", [("op3_license_scan", "licenses", 60), ("op7_line_quality", "n_line_words", 100), ("op8_secrets", "verdicts", 100)])
def test_planted_rows_equal_their_sql(spark, planted, name, column, least):
    got, want = both(spark, planted, name)
    assert got == want
    at = got[0].index(column)
    assert sum(r[at] not in ("", "0") for r in got[1]) >= least
