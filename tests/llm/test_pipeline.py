import random
import shutil

import pytest

import corpus_pipeline as cp
from isobar.llm import bpe, ngram_join
from isobar.llm.queries import ORACLES, QUERIES, vocabulary_path


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder with documents and labels of known content."""
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(2, 8))) for _ in range(300)]
    block = "\n".join(" ".join(r.choice(words) for _ in range(8)) for _ in range(12))
    docs, labels = [], []
    for i in range(300):
        lines = [" ".join(r.choice(words) for _ in range(r.randint(4, 12))) for _ in range(r.randint(2, 8))]
        if i % 10 == 1:
            lines[0] += " zorgle zorglung"
        if i % 25 == 2:
            lines += block.split("\n")
        text = "\n".join(lines)
        if i % 30 == 4:
            w = docs[i - 1][1].split(" ")
            text = " ".join(w[:-1] + ["changed"])
        docs.append((i, text, "en", f"s{i % 3}" if i % 7 else None, len(text)))
        if r.random() < .8:
            labels.append((i, 1, int(i % 10 == 1)))
    docs += [(900, "", "en", "s1", 0), (901, None, None, None, None)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.mode("overwrite").parquet(path + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite") \
        .parquet(path + "/labels.parquet")
    yield path
    shutil.rmtree(path, ignore_errors=True)


def test_stages(spark, small):
    docs = spark.read.parquet(small + "/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    before = {r["doc_id"]: r for r in spark.read.parquet(small + "/documents.parquet").collect()}
    assert set(before) - set(seen["toxicity"]) == {i for i in range(300) if i % 10 == 1}
    cut = {i for i, r in seen["line_dedup"].items() if r["text"] != before[i]["text"]}
    assert set(seen["line_dedup"]) == set(seen["toxicity"])
    # texts with the shared block, and the near copies of other texts, lose chunks; no others do
    assert {i for i in cut if i % 25 != 2 and i % 30 != 4} == set() and len(cut) >= 8
    # the near copies of other texts come whole to the join, and all of them go
    whole = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
             for i in seen["toxicity"] if (w := (before[i]["text"] or "").split())}
    near = {i for i in whole if i % 30 == 4 and i - 1 in whole
            and 10 * len(whole[i] & whole[i - 1]) >= 8 * len(whole[i] | whole[i - 1])}
    assert len(near) >= 4 and not near & set(seen["ngram_jaccard_join"])
    gone = set(seen["line_dedup"]) - set(seen["ngram_jaccard_join"])
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
            for i, r in seen["line_dedup"].items() if (w := (r["text"] or "").split())}
    for i in gone:      # each has an earlier near copy
        assert any(j < i and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) for j in sets)
    for i in seen["ngram_jaccard_join"]:
        assert not any(j < i and j in seen["ngram_jaccard_join"]
                       and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) for j in sets if i in sets)
    assert set(seen["mixing"]) <= set(seen["ngram_jaccard_join"])


def test_run_gives_token_digests_of_the_mix(spark, small):
    out = [tuple(r) for r in cp.run(spark, small).collect()]
    v = bpe.Vocabulary(bpe.read_spec(vocabulary_path()))
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(small + "/documents.parquet").collect()}
    assert len(out) > 100
    same = sum(x[1:] == v.digest(before[x[0]]) for x in out)
    assert same > 0.9 * len(out)      # all but the texts that lost lines


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.mode("overwrite").parquet(path + "/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.mode("overwrite") \
        .parquet(path + "/labels.parquet")
    assert cp.run(spark, path).collect() == []


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert ngram_join.GRAM == 5 and ngram_join.THRESHOLD == 0.8
