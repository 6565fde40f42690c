"""run() against a plain version of its stages, and each stage's promises."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from cairnflow.llm import langid
from cairnflow.llm.common import numbered
from cairnflow.llm.mixing import targets

EN, FR = "the and of that with from this have were been into over", "le les une dans pour avec mais vous elle nous sur par"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(160):
        text = " ".join(rng.choice((EN if k % 3 else FR).split(), 25)) + " " + " ".join(f"{'thing' if k % 3 else 'chose'}{x}" for x in rng.integers(0, 9999, 40))
        rows.append((k, text, "en" if k % 3 else "fr", f"s{k % 3}", len(text)))
    rows += [(200 + k, rows[k][1].replace(" ", "\n"), *rows[k][2:]) for k in range(12)]
    rows += [(300 + k, rows[20 + k][1] + " extra", *rows[20 + k][2:]) for k in range(12)]
    rows += [(400, None, None, "s0", None), (401, "12 34", "en", "s1", 5), (402, "", "en", None, 0), rows[0]]
    path = tmp_path_factory.mktemp("data")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_run_against_plain_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit_language_model(langid.learnable(docs))
    kept = [r for r in langid.label_languages(docs, model).collect() if r.lang_pred != "und" and r.score >= cp.LEAST_SCORE]
    by_text = defaultdict(list)
    for r in kept:
        by_text[re.sub(r"[\x20\x09-\x0D]", "", r.text)].append(r)
    kept = [min(own, key=lambda r: (-len(r.text), r.doc_id)) for own in by_text.values()]
    sets = {r.doc_id: {tuple(r.text.lower().split()[i : i + 5]) for i in range(len(r.text.split()) - 4)} for r in kept}
    stay = [r for r in sorted(kept, key=lambda r: r.doc_id) if not any(o.doc_id < r.doc_id and 100 * len(sets[o.doc_id] & sets[r.doc_id]) >= 80 * len(sets[o.doc_id] | sets[r.doc_id]) for o in kept)]
    size = Counter()
    for r in stay:
        size[r.source] += len(r.text.split())
    goal, library = targets(list(size.items())), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = cp.run(spark, folder).collect()
    text = {r.doc_id: r for r in stay}
    taken = Counter()
    for r in out:
        assert r.ids == library.encode(text[r.doc_id].text, add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False) and r.n_tokens == len(r.ids)
        taken[r.source] += len(text[r.doc_id].text.split())
    assert max(Counter(r.doc_id for r in out).values()) <= 3
    assert all(abs(taken[s] - goal[s]) <= 70 for s in goal)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == COLUMNS, name
        empty = stage(spark, docs.where("doc_id < 0"), folder)
        assert empty.columns == COLUMNS and empty.count() == 0, name
    assert [r.doc_id for r in cp.drop_copies(spark, docs, folder).where("doc_id IN (0, 200)").collect()] == [0]
    assert cp.drop_near_copies(spark, docs, folder).where("doc_id >= 300 AND doc_id < 312").count() == 0
    assert cp.language_id(spark, docs, folder).where("doc_id IN (400, 401, 402)").count() == 0


def test_rows_keep_their_numbers_when_scans_are_split_otherwise(spark, tmp_path):
    rows = [(k, " ".join(f"w{k % 40}x{j}" for j in range(60)), "en", "s", 1) for k in range(80)]
    for k in range(8):
        spark.createDataFrame(rows[10 * k : 10 * k + 10], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    sizes = ("4000", str(1 << 30))
    try:
        seen = []
        for size in sizes:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
            seen.append({r["__row"]: r.doc_id for r in numbered(docs, "__row").collect()})
        assert seen[0] == seen[1] and len(seen[0]) == 80
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        for stage in (cp.drop_copies, cp.drop_near_copies):
            spark.conf.set("spark.sql.files.maxPartitionBytes", sizes[0])
            out = stage(spark, docs, str(tmp_path))
            spark.conf.set("spark.sql.files.maxPartitionBytes", sizes[1])
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
            assert len({r.text for r in out.collect()}) == out.count() == 40, stage.__name__
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    finally:
        for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism"):
            spark.conf.unset(name)
    plain = numbered(spark.createDataFrame(rows, docs.schema), "__row").collect()
    assert len({r["__row"] for r in plain}) == 80


def test_users_columns_and_long_texts_pass(spark, folder):
    """Columns named like those that stages make for themselves keep their values; a text of 60,000 words goes through."""
    long = " ".join(f"the{k}" for k in range(60_000))
    made = spark.createDataFrame([(k, f"{EN} {EN} word{k} and so on", "en", "s0", 9, f"r{k}", f"n{k}", f"t{k}") for k in range(6)] + [(9, long, "en", "s1", 9, "r9", "n9", "t9")], "doc_id long, text string, lang string, source string, n_chars long, __ROW string, __nth string, __times string")
    made = made.withColumns({"lang_pred": F.col("doc_id") + 7, "score": F.lit("mine"), "runs": F.lit(2), "c1": F.lit("c")})
    made.write.mode("overwrite").parquet(f"{folder}/clash.parquet")
    docs = spark.read.parquet(f"{folder}/clash.parquet")
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert all((r.lang_pred, r.score, r.runs, r.c1) == (r.doc_id + 7, "mine", 2, "c") for r in out.collect()), name
        assert all((r["__ROW"], r["__nth"], r["__times"]) == (f"r{r.doc_id}", f"n{r.doc_id}", f"t{r.doc_id}") for r in out.collect()), name
    assert any(r.doc_id == 9 and r.n_tokens > 60_000 for r in cp.STAGES[4][1](spark, docs, folder).collect())


def test_languages_of_four_and_mixed_texts_stay(spark, folder):
    """Held-out rows of all four languages stay, and so do texts of two; other scripts and texts without letters go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.lang: r.text for r in docs.where("length(text) > 400").collect()}
    assert len(texts) == 4
    mixed = [(10**6 + k, texts[a][:300] + " " + texts[b][:300], a, "s", 1) for k, (a, b) in enumerate((a, b) for a in texts for b in texts if a < b)]
    bad = [(2 * 10**6 + k, t, None, "s", 1) for k, t in enumerate((None, "", "123 456 -- !!", "   "))]
    spark.createDataFrame(mixed + bad, docs.schema).union(docs).write.mode("overwrite").parquet(f"{folder}/mixed.parquet")
    rows = spark.read.parquet(f"{folder}/mixed.parquet")
    kept = {r.doc_id for r in cp.language_id(spark, rows, folder).collect()}
    assert {k for k, *_ in mixed} <= kept and not {k for k, *_ in bad} & kept
    plain = docs.where(F.coalesce(F.col("text"), F.lit("")).rlike("[A-Za-zÀ-ÿ]{3}"))
    assert {r.doc_id for r in plain.collect()} <= kept
