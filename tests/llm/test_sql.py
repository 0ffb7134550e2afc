"""Check SQL of the text queries: equal rows on both engines, on the given tables and on hard rows."""

import pytest

from checks.compare import connect, duck_rows, spark_rows
from cohortlink.llm.queries import QUERIES, oracle_sql

DIRECTORY = "/root/testdata/sf0.001"
SQL = oracle_sql()
ON_TEXTS = ["op1_ngram_jaccard_join", "op2_substring_dedup", "op6_decontamination", "op8_secret_scans"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_on_both_engines(spark, name):
    got = spark_rows(QUERIES[name](spark, DIRECTORY))
    assert got == duck_rows(connect(DIRECTORY), SQL[name])


def hard_texts():
    long = " ".join(f"w{k % 701}x{k % 13}" for k in range(9000))
    passage = " ".join(f"Item{k} word" for k in range(12))
    texts = [
        None, "", " \t\n", "one", "one two three four", "One TWO three four", long, long + " end", "start " + long,
        f"before {passage} after", f"other {passage}", f"{passage} {passage}", "short item here", "SHORT, item; here!",
        "ÄÖ naïve 東京 🙂 words of many kinds in one line", "🙂 token: abcdefgh1234 and secret == 'abc+/=.defghij'",
        "AKIA" + "Q7" * 9 + "akia AKIA12 " + "0f" * 20, "password=short Password : LongEnough99 api_key='0123456789abcdef' apikey:x",
        "key 9fK2mQ7xZ1bV8nR4tY6wE3aPq5Ls0dHj plain aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa example9fK2mQ7xZ1bV8nR4t",
        "x" * 30 + "9fK2mQ7xZ1bV8nR4tY6wE3aP" + "x" * 60 + "9fK2mQ7xZ1bV8nR4tY6wE3aP",
    ]
    texts += [f"row {k} of the copies, all of them alike but for this number and the rest of a long line" for k in range(3)] * 2
    return [(k * 7 - 3, t) for k, t in enumerate(texts)], [(1, passage), (2, "short item here"), (10, None), (11, ""), (3, passage)]


@pytest.fixture(scope="module", params=["hard", "empty"])
def directory(spark, request, tmp_path_factory):
    """Documents, with a clashing column more, and benchmark of hard rows or of none."""
    folder = tmp_path_factory.mktemp(request.param)
    docs, items = hard_texts() if request.param == "hard" else ([], [])
    frames = {
        "documents": spark.createDataFrame([(*r, "x") for r in docs], "doc_id bigint, text string, n_words string"),
        "benchmark": spark.createDataFrame(items, "item_id bigint, text string"),
    }
    for name, frame in frames.items():
        frame.coalesce(1).write.parquet(str(folder / f"{name}.parquet"))
    return folder


@pytest.mark.parametrize("name", ON_TEXTS)
def test_same_rows_on_hard_texts(spark, directory, name):
    con = connect(DIRECTORY)
    for table in ("documents", "benchmark"):
        con.execute(f"create or replace view {table} as select * from '{directory}/{table}.parquet/*.parquet'")
    got = spark_rows(QUERIES[name](spark, str(directory)))
    assert got == duck_rows(con, SQL[name])
