"""The law of the shards as SQL over the whole result."""

import duckdb
import pytest

from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.01"

# Every shard's rows against the documents: sizes, slots, and groups of equal texts.
LAWS = {
    "rows": "SELECT count(*) FROM (SELECT doc_id FROM docs EXCEPT ALL SELECT doc_id FROM got UNION ALL (SELECT doc_id FROM got EXCEPT ALL SELECT doc_id FROM docs))",
    "sizes": "SELECT count(*) FROM got JOIN docs USING (doc_id) WHERE got.size <> coalesce(strlen(text), 0) + 8",
    "slots": "SELECT count(*) FROM (SELECT shard FROM got GROUP BY shard HAVING min(slot) <> 0 OR max(slot) <> count(*) - 1 OR count(DISTINCT slot) <> count(*))",
    "shards": "SELECT count(*) FROM got WHERE shard NOT BETWEEN 0 AND 23 OR law <> 'bytes' OR grown_shard IS NOT NULL",
    "sums": "SELECT count(*) FROM (SELECT sum(size) AS s FROM got GROUP BY shard) WHERE s NOT BETWEEN 0.9 * (SELECT sum(size) / 24 FROM got) AND 1.1 * (SELECT sum(size) / 24 FROM got)",
    "groups": """
        SELECT count(*) FROM (
            SELECT text FROM got JOIN docs USING (doc_id) GROUP BY text
            HAVING count(DISTINCT shard) > 1 AND sum(size) * 8 <= (SELECT sum(size) / 24 FROM got))""",
}


@pytest.fixture(scope="module")
def con(spark):
    got = queries.range_shards(spark, FOLDER).toArrow()
    con = duckdb.connect()
    con.register("got", got)
    con.execute(f"CREATE VIEW docs AS SELECT * FROM '{FOLDER}/documents.parquet'")
    return con


@pytest.mark.parametrize("law", LAWS)
def test_shards_obey(con, law):
    assert con.execute(LAWS[law]).fetchone()[0] == 0
