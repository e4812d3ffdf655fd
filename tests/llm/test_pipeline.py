"""The pipeline's stages on a small folder of tables, each held against a brute-force version."""

import base64
import collections
import hashlib
import math
import random
import re

import public_tokenizers
import pytest

import corpus_pipeline

WORDS = "the river ran past quiet fields and people walked slowly home before night came over old stone bridges where children played".split()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pick = random.Random(11)
    clean = lambda n: " ".join(pick.choice(WORDS) + (str(pick.randrange(50)) if pick.random() < 0.5 else "") for _ in range(n))
    rows = [(i, clean(pick.randrange(30, 120)), "en", f"src{i % 3}") for i in range(200)]
    rows += [(300 + i, " ".join(w + pick.choice(["###", "$$$", "%%%"]) for w in clean(40).split()), "en", "src0") for i in range(60)]
    rows += [(400 + i, rows[i][1].replace(" ", "  ", 3), "en", "src1") for i in range(20)]
    rows += [(500 + i, rows[30 + i][1] + " end", "en", "src2") for i in range(20)]
    rows += [(600, None, "en", "src0"), (601, "", None, None)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "length(text) as n_chars").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 200, 2)] + [(300 + i, 0, 0) for i in range(0, 60, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), "test")
        made.append(docs)
    good, unique, single, mixed, coded = made
    ids = lambda df: collections.Counter(r.doc_id for r in df.select("doc_id").collect())
    assert all(df.columns == ["doc_id", "text", "lang", "source", "n_chars"] for df in made[:4])
    assert set(ids(good)) == {*range(200), *range(400, 420), *range(500, 520)}
    text = {r.doc_id: r.text for r in good.collect()}
    first = {}
    for i in sorted(text):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text[i]), i)
    assert set(ids(unique)) == set(first.values())
    assert set(ids(single)) == set(ids(unique)) - {*range(500, 520)}
    assert set(ids(mixed)) <= set(ids(single)) and max(ids(mixed).values()) <= 3
    size = {i: len(t.split()) for i, t in text.items()}
    assert abs(sum(size[i] * n for i, n in ids(mixed).items()) - sum(size[i] for i in ids(single))) <= 3 * 120
    assert ids(coded) == ids(mixed)
    for r in coded.collect():
        assert r.n_tokens == len(r.ids) > 0
    whole = corpus_pipeline.run(spark, folder)
    assert ids(whole) == ids(coded)


def taken_by_hand(rows, weights=(1, 2, 3), most=3):
    """How often each (id, words, source) is taken: targets by sharing excess again, then a walk along the hashes."""
    hashed = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16)
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, n, x in rows if x == s) for s in sources}
    weight, total = {s: weights[i % len(weights)] for i, s in enumerate(sources)}, sum(size.values())
    target, free = {}, set(sources)
    while free:
        left, shares = total - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if most * size[s] * shares <= left * weight[s]}
        target |= {s: most * size[s] for s in over} if over else {s: left * weight[s] / shares for s in free}
        free = free - over if over else set()
    times = {}
    for s in sources:
        full, need = divmod(math.floor(target[s]), size[s]) if size[s] else (0, 0)
        got = 0
        for i, n, _ in sorted((r for r in rows if r[2] == s), key=lambda r: hashed(r[0])):
            more = full < most and got <= need and (got + n <= need or got + n - need <= need - got)
            times[i], got = full + more, got + n
    return times


def test_mixing_and_encoding_by_hand(spark, folder):
    import tiktoken

    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("text is not null and doc_id < 400 and (source <> 'src2' or doc_id < 20)")
    rows = [(r.doc_id, len(r.text.split()), r.source) for r in docs.collect()]
    mixed = corpus_pipeline.materialise(corpus_pipeline.mixed(spark, docs, folder), "test")
    times = collections.Counter(r.doc_id for r in mixed.collect())
    wanted = taken_by_hand(rows)
    assert {i: times[i] for i in wanted} == wanted and len({*wanted.values()}) > 1
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r.doc_id: r.text for r in docs.collect()}
    coded = corpus_pipeline.encoded(spark, mixed, folder).collect()
    assert collections.Counter(r.doc_id for r in coded) == times
    for r in coded:
        ids = library.encode_ordinary(text[r.doc_id])
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


CLASHING = {"kept": "'x'", "n_words": "7", "keep_id": "-1", "group_size": "'g'", "__plan": "8", "__id": "'i'", "__copy": "9", "__text": "'t'", "size": "5", "id": "6", "carried_0": "'c'",
            "component_id": "4", "ids": "array(1)", "text_sha256": "3", "__norm": "2", "label": "1", "node": "'n'"}


def test_columns_with_clashing_names_come_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain, wide = docs, docs.selectExpr("*", *[f"{v} as `{k}`" for k, v in CLASHING.items()])
    columns, values = wide.columns, wide.select(*CLASHING).distinct().collect()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        plain = corpus_pipeline.materialise(stage(spark, plain, folder), "plain")
        wide = corpus_pipeline.materialise(stage(spark, wide, folder), "wide")  # two runs by turns
        want = sorted(repr(r) for r in plain.collect())
        if number < 4:
            assert wide.columns == columns and wide.select(*CLASHING).distinct().collect() == values
        assert sorted(repr(r) for r in wide.select(*plain.columns).collect()) == want


def test_a_second_run_leaves_the_first_one_alone(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    good = corpus_pipeline.materialise(stages[0](spark, docs, folder), "good")
    lazy = stages[1](spark, good, folder)  # not written yet
    corpus_pipeline.run(spark, folder)
    assert lazy.count() > 100
    unique = corpus_pipeline.materialise(lazy, "unique")
    left = unique.schema["doc_id"].metadata[corpus_pipeline.LEFT]
    assert left
    stages[2](spark, unique, folder)
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(left[0])


def test_empty_and_null_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("empty", []), ("nulls", [(None, None, None, None, None)] * 3 + [(1, "", None, None, 0)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{name}").count() == 0
