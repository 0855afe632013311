import pytest


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, source) as a documents table, with columns that clash with internal names."""

    def make(rows):
        filled = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in rows]
        frame = spark.createDataFrame(filled, "doc_id bigint, text string, source string")
        extra = "lang string, n_chars bigint, key string, row bigint, shard int, kept string, size int, host string, _row bigint, _old_shard string, _file string, file string, document string, label string, block int"
        names = [c.split()[0] for c in extra.split(", ")]
        return frame.selectExpr("*", *[f"CAST('7' AS {c.split()[1]}) AS {n}" for c, n in zip(extra.split(", "), names)])

    return make


#: Texts that every operator has to live with.
HARD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (None, "no number at all here"), (5, "ünïcödé " * 3), (6, "x" * 200_000), (7, "word " * 30_000), (7, "word " * 30_000), (8, "\n\n\n")]
