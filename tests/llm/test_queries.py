"""The registered queries, the pipeline, and life without either."""

import importlib.util
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from harborline.llm.oracles import ORACLES
from harborline.llm.queries import QUERIES

ROOT = Path(__file__).resolve().parents[2]
DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "op1": ["doc_id", "held_out", "score", "predicted"], "op2": ["doc_id", "n_shingles", "component_id"],
    "op3": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4": ["doc_id", "item_id"], "op5": ["doc_id", "held_out", "score", "predicted"], "op6": ["doc_id", "path", "licence"],
    "op7": ["doc_id", "held_out", "lang_pred", "score"],
    "op8": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op10": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op11": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op13": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    out = QUERIES[name](spark, str(DATA))
    want = COLUMNS[name.split("_")[0]]
    assert [c for c in out.columns if c in want] == want or set(want) <= set(out.columns)
    kinds = dict(out.dtypes)
    for c in want:
        assert kinds[c] in ("bigint", "string", "boolean", "double", "int"), (c, kinds[c])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "conversations"):
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    got, want = QUERIES[name](spark, str(DATA)), con.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = lambda found, columns: sorted(repr(tuple(r[columns.index(n)] for n in names)) for r in found)
    assert rows([tuple(r) for r in got.collect()], got.columns) == rows(want.fetchall(), want.columns)


def test_pipeline_stages_hold(spark):
    sys.path.insert(0, str(ROOT))
    import corpus_pipeline

    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, str(DATA)), name)
        assert docs.columns == columns
        seen.append(docs.count())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and sorted(seen, reverse=True) == seen and seen[-1] > seen[0] / 2
    assert docs.where("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA))
    assert packed.select("doc_id").distinct().count() == seen[-1]
    whole = corpus_pipeline.run(spark, str(DATA))
    drop = ["sequence_id", "offset", "padding"]
    assert sorted(whole.drop(*drop).collect()) == sorted(packed.drop(*drop).collect())


def test_stages_take_empty_tables(spark):
    sys.path.insert(0, str(ROOT))
    import corpus_pipeline

    docs = spark.read.parquet(str(DATA / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(DATA)).count() == 0


def test_entry_point_lives_without_this_folder(tmp_path):
    for name in ("harborline", "workload"):
        (tmp_path / name).symlink_to(ROOT / name)
    package = tmp_path / "bare"
    package.mkdir()
    code = (ROOT / "__spark_entry__.py").read_text()
    (package / "entry.py").write_text(code)
    blocker = ("import sys\n"
               "class Gone:\n"
               "    def find_spec(self, name, *a):\n"
               "        if name.startswith('harborline.llm') or name == 'corpus_pipeline':\n"
               "            raise ModuleNotFoundError(name, name=name)\n"
               "sys.meta_path.insert(0, Gone())\n"
               f"sys.path.insert(0, {str(tmp_path)!r})\n"
               f"sys.path.insert(0, {str(package)!r})\n"
               "import entry\n"
               "names = entry.queries()\n"
               "assert names and not [n for n in names if n.startswith('op') or n == 'pipeline'], names\n"
               "assert set(entry.oracle_sql()) <= set(names)\n")
    done = subprocess.run([sys.executable, "-c", blocker], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_uses_this_folder():
    for path in [*(ROOT / "harborline").rglob("*.py"), *(ROOT / "workload").rglob("*.py")]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "harborline.llm" not in path.read_text(), path


def test_entry_point_lists_everything():
    spec = importlib.util.spec_from_file_location("entry_for_llm", ROOT / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in entry.queries()) == 1
