"""The corpus pipeline, stage by stage, against brute force on a small table."""

import random

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from test_jaccard import brute as components
from test_lines import brute as dedup

from cohortcast.llm import bpe, mixing

WORDS = {"en": "the of and to in is that it was for on with as by at from this be or are".split(),
         "de": "der die und das ist nicht ein eine mit von auf für dem den zu sich wird über".split(),
         "fr": "le la les et des une dans est que pour qui sur avec pas au par plus être été".split()}


def documents():
    rng = random.Random(9)
    say = lambda lang, n: " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "n", "s", str(rng.randrange(99))]) for _ in range(n))
    rows, passage = [], "\n".join(say("en", 9) for _ in range(5))
    for i in range(150):
        lang = ["en", "en", "de", "fr"][i % 4]
        rows.append((say(lang, rng.randrange(5, 60)) + ("\n" + passage if i % 17 == 0 else ""), lang if i % 13 else None, f"src{i % 7}" if i % 19 else None))
    rows += [rows[3], rows[7], (rows[9][0] + " x", "en", "src1"), (" ".join(rows[11][0].split()[:-1]), "fr", "src0"), ("12 34 !?", "en", "src2"),
             ("", "en", "src2"), (None, None, None), (passage, "en", "src3"), ("q" * 9000, "en", "src0")]
    return [(i, t, lang, s, len(t or "")) for i, (t, lang, s) in enumerate(rows)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf_dir = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf_dir}/documents.parquet")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{sf_dir}/{k}")
        out.append((docs, spark.read.parquet(f"{sf_dir}/{k}")))
        docs = out[-1][1]
    return sf_dir, out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_keep_the_columns_of_documents(stages):
    for before, after in stages[1][:-1]:
        assert after.dtypes == before.dtypes


def test_language_id_drops_what_has_no_letter(stages):
    before, after = stages[1][0]
    assert pairs(after) == sorted((i, t) for i, t in pairs(before.where("text IS NOT NULL")) if any(c.isalpha() for c in t))
    named = {r.doc_id: r.lang for r in after.collect()}
    own = {i: lang for i, _, lang, *_ in documents()}
    assert all(named[i] == own[i] for i in named if own[i])
    assert sum(named[i] == ["en", "en", "de", "fr"][i % 4] for i in range(0, 150, 13)) >= 9  # named by the network


def test_line_dedup(stages):
    before, after = stages[1][1]
    want = [(i, t, n) for i, t, n in dedup(pairs(before)) if not n or t]
    assert pairs(after) == sorted((i, t) for i, t, _ in want) and sum(n for *_, n in want) > 20
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_duplicates(stages):
    before, after = stages[1][2]
    want = {i for i, _, c in components(pairs(before)) if i == c}
    assert [i for i, _ in pairs(after)] == sorted(want) and len(want) < before.count()


def test_mixing(stages):
    before, after = stages[1][3]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [tuple(r) for r in before.select("doc_id", "text", "lang", "source").collect()])
    want = sorted(r[0] for r in con.sql(mixing.oracle(corpus_pipeline.RECIPE)).fetchall())
    assert [i for i, _ in pairs(after)] == want and 0 < len(want) < before.count()


def test_tokens(stages):
    before, after = stages[1][4]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    got = sorted((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in after.collect())
    assert got == [(i, len(ids := library.encode_ordinary(t)), ids, t) for i, t in pairs(before)]


def test_run_and_empty_table(spark, stages, tmp_path):
    sf_dir, out = stages
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, out[-1][1].collect()))
    out[0][0].limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
