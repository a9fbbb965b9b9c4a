import duckdb

from larkspur.llm import merkle
from tests.llm import brute

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def made(docs):
    return sorted((tuple(r) for r in merkle.manifest(docs).select(*COLUMNS).collect()), key=repr)


def test_query_equals_brute_force_and_sql(spark):
    from larkspur.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_merkle_manifest"](spark, folder).collect()), key=repr)
    assert found == sorted(brute.merkle(rows), key=repr)
    assert 0 < sum(r[-1] for r in found) < len(found)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        cursor = con.execute(ORACLES["op12_merkle_manifest"])
        place = [[d[0] for d in cursor.description].index(c) for c in COLUMNS]
        assert sorted((tuple(r[i] for i in place) for r in cursor.fetchall()), key=repr) == found


def test_nulls_ties_lone_leaves_and_repeated_rows(spark):
    rows = [(i, f"Text {i}", "en", "s", 6) for i in range(75)]
    rows += [(i, "É" if i % 2 else None, None, None, None) for i in range(9)]
    rows += [(None, "", "de", "", 0), (5, "Lone", "", "s", 4), (7, "A", "zz", "s", 1), (7, "B", "zz", "s", 1), (8, "X", "yy", "s", 1), (8, "X", "yy", "s", 1)]
    rows += [(i, "Q", f"l{i:02}", "s", 1) for i in range(70)]  # more groups than one run holds
    docs = spark.createDataFrame([(*r, "no", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, digest string, size int")
    assert made(docs) == sorted(brute.merkle(rows), key=repr)


def test_one_large_group_is_cut_into_blocks(spark):
    rows = [(i, f"T{i}", "en", "s", 2) for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert made(docs) == sorted(brute.merkle(rows), key=repr)


def test_empty_table(documents):
    assert made(documents([])) == []
