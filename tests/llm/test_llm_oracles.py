"""The operators that have SQL give what DuckDB gives on the smallest tables, and on rows of odd shapes."""

import duckdb
import pytest

from corpusloom.llm import oracles, quality_rules, registry, secrets

D = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


def duck_rows(sql, relation, table="documents"):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM {relation}")
    cur = con.execute(sql)
    return sorted_rows([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    df, table = registry.queries()[name](spark, D), "conversations" if name.startswith("op11_") else "documents"
    assert sorted_rows(df.columns, df.collect()) == duck_rows(SQL[name], f"'{D}/{table}.parquet'", table)


def test_odd_rows_same_as_sql(spark, docs, tmp_path):
    keys = ["password = 'hunter2hunter2'", "AKIA" + "Q7" * 9, "deadbeef" * 4, "token: abc", "xY7-" * 8 + " api_key=xY7-" + "xY7-" * 7, "é passwd:" + "k9" * 12 + " é"]
    odd = [(900 + i, f"{k} and {keys[i % 3]}\nsecret:{k}", f"s{i % 2}") for i, k in enumerate(keys)] + [(950, " ".join(keys * 40), None)]
    rows = docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame(odd, "doc_id long, text string, source string"))
    rows.coalesce(1).write.parquet(str(tmp_path / "d"))
    for name, df in (("op1_quality_rules", quality_rules.quality_rules(rows)), ("op4_secrets", secrets.digests(secrets.secret_spans(rows)))):
        assert sorted_rows(df.columns, df.collect()) == duck_rows(SQL[name], f"'{tmp_path}/d/*.parquet'"), name
