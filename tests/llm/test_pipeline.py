"""The pipeline's stages against their operators on a small corpus, and the run against a plain version."""

import random

import corpus_pipeline
from reelcat.llm import pieces

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(500)]
    rows = []
    for i in range(120):
        rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 120)))))
    rows += [(200 + i, rows[i][1].upper()) for i in range(20)]  # exact but for case
    rows += [(300 + i, rows[30 + i][1] + " tail") for i in range(20) if len(rows[30 + i][1].split()) > 60]
    rows += [(400, "too short"), (401, None), (402, "again and again it goes round " * 9)]
    return [(i, t, "en", f"s{min(i % 7, 2)}", len(t or "")) for i, t in rows]


def test_run_keeps_what_the_plain_version_keeps(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {i: t for i, t, *_ in rows if i < 400}
    last = {}
    for i, t in kept.items():
        last[t.lower()] = max(i, last.get(t.lower(), i))
    kept = {i: kept[i] for i in last.values()}
    sets = {i: (lambda w: {tuple(w[k : k + 4]) for k in range(len(w) - 3)})(t.lower().split()) for i, t in kept.items()}
    kept = {i: t for i, t in kept.items() if not any(j < i and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]) for j in kept)}
    assert {r.doc_id: r.text for r in out} == kept
    assert all(r.exact and r.n_tokens == len(r.ids) for r in out)
    counts = {}
    for r in out:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 4 and min(counts.values()) == 1
    v = pieces.vocabulary()
    assert all(0 <= i < len(v.contents) for i in out[0].ids)


def test_stages_return_the_columns_of_documents_and_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_near_duplicates_judges_rows_without_an_id_or_with_a_shared_one(spark):
    rng = random.Random(5)
    a, b, c, d, e, f, g = (" ".join(f"word{rng.randrange(500)}" for _ in range(80)) for _ in range(7))
    rows = [(3, a), (5, a + " tail"), (5, b), (None, c), (None, c + " tail"), (None, d), (2, e), (4, e + " tail"), (2, f), (1, g), (1, g + " tail"), (1, g), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted((i or 0, (t or "").removesuffix(" tail")) for i, t in got) == sorted(
        [(3, a), (5, b), (0, c), (0, d), (2, e), (2, f), (1, g), (9, ""), (0, "")])
