import pytest

#: Columns that operators use inside, all of them on the input as well.
CLASHING = ", ".join(f"{c} string" for c in ("n", "key", "d", "s", "word", "term", "pos", "length", "rep", "bucket", "rank", "mark", "owner", "place", "digest", "n_tokens", "held_out", "score", "kept"))


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) as a table with all columns of documents and clashing ones."""

    def make(rows, extra=True):
        shape = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(i, t, "en" if t else None, None, len(t or "")) for i, t in rows]
        if extra:
            shape = f"{shape}, {CLASHING}"
            full = [(*r, *["x"] * (CLASHING.count(",") + 1)) for r in full]
        return spark.createDataFrame(full, shape)

    return make


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


WORDS = "the of and river stone light water house green cloud paper north small table glass winter road field bread".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "ly", "ful"]) for _ in range(n))
