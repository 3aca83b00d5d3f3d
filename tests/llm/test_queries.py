"""The registered queries: against SQL on given tables, and on odd tables."""

import duckdb
import pytest
from conftest import SF_DIR

import corpus_pipeline
from ledgerloom.llm import minmax
from ledgerloom.llm.queries import ORACLES, QUERIES

LONG = " ".join(f"word{i % 97} longer{i}" for i in range(20_000))
DOCUMENTS = [
    (1, LONG, "en", "a"), (2, LONG, "en", "a"), (3, None, "en", "a"), (4, "", None, None), (5, " \n\t ", "de", "b"),
    (6, "one", "de", "b"), (7, "One", "fr", "b"), (8, "a b c\nA b c", "fr", None), (9, "x " * 200, "es", "c"), (10, "#$%|| 12", "es", "c"),
    (11, "same words here " * 30, "en", "d"), (12, "same words here " * 30, "en", "d"),
]
PAGES = [(1, "http://a.b/c", "<p>x</p>"), (2, "http://a.b/d", "<p>x</p>"), (3, None, None), (4, "", ""), (5, "http://a.b/e", "<article>" + LONG + "</article>")]
TURNS = [(1, 0, "user", "a<|b"), (1, 1, "assistant", None), (1, 1, "assistant", "t\\<|"), (2, None, None, "x"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y")]
WIDE = [0.25 * i - 3 for i in range(64)]
VECTORS = [(1, WIDE), (1, WIDE), (2, WIDE[::-1]), (3, WIDE[:-1]), (4, None), (5, WIDE[:-1] + [None]), (6, WIDE[:-1] + [float("nan")]), (None, [0.0] * 64), (7, [])]
TABLES = {
    "embeddings": (VECTORS, "vec_id long, embedding array<float>"),
    "documents": (DOCUMENTS, "doc_id long, text string, lang string, source string"),
    "pages": (PAGES, "page_id long, url string, html string"),
    "conversations": (TURNS, "conv_id long, turn long, role string, text string"),
    "benchmark": ([(1, "no such item in any text at all here"), (2, None)], "item_id long, text string"),
}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Odd tables, with columns whose names operators use themselves; and empty ones."""
    out = {}
    for kind in ("odd", "empty"):
        out[kind] = str(tmp_path_factory.mktemp(kind))
        for name, (rows, schema) in TABLES.items():
            clash = ", n_chars long, kept string, block string, part int, score int, hash string, size string, id string"
            rows = [(*r, 1, "k", "b", 7, 3, "h", "s", "i") for r in rows] if kind == "odd" else []
            spark.createDataFrame(rows, schema + clash).write.parquet(f"{out[kind]}/{name}.parquet")
    return out | {"given": SF_DIR}


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("kind", ["given", "odd", "empty"])
def test_against_sql(spark, folders, name, kind):
    duck = duckdb.connect()
    for table in TABLES:
        path = f"{folders[kind]}/{table}.parquet"
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path if kind == 'given' else path + '/*.parquet'}'")
    df = QUERIES[name](spark, folders[kind])
    columns = sorted(df.columns)
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    expected = relation.select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(map(repr, expected))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_tables(spark, folders, name, kind):
    rows = QUERIES[name](spark, folders[kind]).collect()
    table = "pages" if name.startswith("op9") else "documents"
    if name.startswith("op2"):
        assert not rows
    else:
        assert len(rows) == (len(TABLES[table][0]) if kind == "odd" else 0)


def test_dedup_keeps_null_ids_and_one_row_of_an_id(spark):
    rows = [(None, "a b c d e f", "x"), (None, "a b c d e f", "x"), (None, None, None), (1, "q r s t u v", "z"), (1, "q r s t u v", "y"), (2, "q r s t u v", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, first_ string")
    left = sorted((r.doc_id or 0, r.text or "", r.first_ or "") for r in corpus_pipeline.deduplicated(spark, docs, "").collect())
    assert left == [(0, "", ""), (0, "a b c d e f", "x"), (0, "a b c d e f", "x"), (1, "q r s t u v", "y")]


def test_leaks_without_an_id_go(spark, tmp_path):
    item = "a farmer keeps twelve brown hens near the old mill and sells their eggs in town"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "so " + item), (None, "so " + item), (None, "other words"), (None, None), (1, item), (2, "other words"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect())
    assert left == [(0, ""), (0, "other words"), (2, "other words"), (3, "")]


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_pipeline_on_odd_tables(spark, folders, kind):
    docs = spark.read.parquet(f"{folders[kind]}/documents.parquet")
    got = corpus_pipeline.run(spark, folders[kind])
    assert got.columns == [*docs.columns, "copies_", "taken_"]
    ids = {r.doc_id for r in got.collect()}
    assert ids <= {1, 6, 8, 9, 10, 11} if kind == "odd" else not ids


def test_pipeline_stages(spark):
    """Each stage's decision, on its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name == "minhash_near_dedup":
            kept = minmax.near_duplicates(docs).where("kept")
            assert ids(out) == ids(kept) and out.count() == kept.count()
        elif name == "benchmark_decontamination":
            assert ids(docs) - ids(out) == ids(QUERIES["op2_decontamination"](spark, SF_DIR)) != set()
        elif name == "substring_dedup":
            cut = {r.doc_id for r in QUERIES["op6_repeated_phrases"](spark, SF_DIR).where("n_removed > 0").collect()}
            before, after = ({r.doc_id: r.text for r in df.collect()} for df in (docs, out))
            assert {k for k in before if before[k] != after[k]} == cut != set()
        elif name == "source_mixing":
            taken = {r.doc_id: r.taken for r in QUERIES["op8_mixture"](spark, SF_DIR).where("taken > 0").collect()}
            assert {r.doc_id: r.taken_ for r in out.where("taken_ > 0").collect()} == taken
        if name != "source_mixing":
            assert out.columns == docs.columns
