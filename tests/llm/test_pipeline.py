"""The pipeline's stages on planted cases, and against plain versions."""

import random

import numpy as np
import pytest

import corpus_pipeline as P


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    r = random.Random(12)
    vocabulary = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("st", "rk", "nd", "p")]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows, labels = [], []
    for k in range(300):
        toxic = k % 5 == 0
        t = text(60)
        rows.append((k, t + (" grumtoad zorgish" if toxic else ""), "en", f"s{k % 3}", 0))
        labels.append((k, 1, int(toxic)))
    near = rows[1][1].split()
    rows.append((900, rows[1][1], "en", "s0", 0))
    rows.append((901, " ".join([*near[:30], "edited", *near[31:]]), "en", "s1", 0))
    rows.append((902, text(40) + " token = 0123456789abcdef0123456789abcdef", "en", "s1", 0))
    rows.append((903, None, None, None, None))
    rows.append((904, "", "en", "s2", 0))
    path = tmp_path_factory.mktemp("pipe")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_stages(spark, data):
    docs = P.table(spark, data, "documents").select(*P.COLUMNS)
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, data)
        assert docs.columns == P.COLUMNS, name
        docs = docs.cache()
        ids = [r["doc_id"] for r in docs.collect()]
        if name == "toxicity":
            assert set(ids) == set(range(300)) - set(range(0, 300, 5)) | {900, 901, 902, 903, 904}
        if name == "near_duplicates":
            assert len(ids) == len(set(ids)) and {900, 901} & set(ids) == set() and {1, 902, 903, 904} <= set(ids) and before.count() == len(ids) + 2
        if name == "secrets":
            assert before.count() == docs.count() and "0123456789" not in docs.where("doc_id = 902").first()["text"]
        if name == "mix":
            assert {903, 904} & set(ids) == set() and len(ids) > len(set(ids)) > 200
    packed = P.STAGES[-1][1](spark, docs, data).toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024 and np.isin(packed["doc_id"], list(set(ids))).all()


def test_run_agrees_with_itself_and_takes_no_rows(spark, data, tmp_path):
    a, b = (P.run(spark, data).select("doc_id", "piece", "start", "length", "ids_crc32") for _ in range(2))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count() > 0
    P.table(spark, data, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    P.table(spark, data, "labels").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_and_secrets_against_brute_force(spark):
    """The two stages on texts near the threshold and with planted keys, against plain versions."""
    from test_operators import plain_base, plain_groups

    r = random.Random(44)
    word = lambda: f"w{r.randrange(900)}"
    texts = []
    for k in range(80):
        w = [word() for _ in range(r.choice([8, 40, 120]))]
        n = max(1, round(len(w) * r.choice([0.02, 0.05, 0.1, 0.2])))
        texts += [" ".join(w), " ".join(w[:-n] + [word() for _ in range(n)])]
        if k % 4 == 0:
            texts[-1] += " secret = abcdefgh1234 0123456789abcdef0123456789abcdef"
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(x["doc_id"] for x in P.drop_near_duplicates(spark, docs, "").collect())
    assert kept == sorted(set(plain_groups(texts).values())) and len(kept) < len(texts)
    for x in P.redact_secrets(spark, docs, "").collect():
        t, out, at = texts[x["doc_id"]], [], 0
        for s, e, _ in plain_base(t):
            if e > at:
                out += [t[at:s], "[SECRET]"] if s >= at else []
                at = e
        assert x["text"] == "".join([*out, t[at:]]) and x["n_chars"] == len(x["text"])


def test_near_duplicates_go_through_simhash(spark, monkeypatch):
    """Without any band, what SimHash groups is found and decided on the sets of shingles."""
    from tidelake.llm import near, simhash

    r = random.Random(5)
    w = [f"w{r.randrange(5000)}" for _ in range(400)]
    apart = lambda a, b: ((simhash.fingerprint(a) ^ simhash.fingerprint(b)) & (2**64 - 1)).bit_count()
    near_copy = next(t for k in range(1, 399) if apart(t := " ".join([*w[:k], "edited", *w[k + 1 :]]), " ".join(w)) in (1, 2, 3))
    other = " ".join([*w[:200], *(f"v{k}" for k in range(200))])
    texts = [" ".join(w), near_copy, other]
    marks = near.marks_of

    def no_bands(h, sizes):
        key, bands = marks(h, sizes)
        return key, bands[:, :0]

    monkeypatch.setattr(near, "marks_of", no_bands)
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(x["doc_id"] for x in P.drop_near_duplicates(spark, docs, "").collect()) == [0, 2]


def test_few_written_edges_are_not_written_again(spark, monkeypatch):
    from tidelake.llm import components

    written = []
    keep = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, tag: written.append(tag) or keep(df, tag))
    edges = spark.createDataFrame([(2, 1), (1, 2), (3, 2), (5, 5), (9, 7)], "a long, b long")
    got = sorted(tuple(x) for x in components.components(edges, written=True).collect())
    assert got == [(2, 1), (3, 1), (9, 7)] and written == ["edges"]
    assert got == sorted(tuple(x) for x in components.components(edges).collect())
