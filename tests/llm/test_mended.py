"""Earlier operators on inputs they once failed: settings that change between
sessions, string and repeated ids, clashing names, copies, long documents."""

from __future__ import annotations

import zlib

import numpy as np

import corpus_pipeline as pipeline
from strata.llm import exact_dedup, licences, mixing, quality, sharding, topk
from strata.llm import queries as registered
from strata.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_index_keeps_its_layout_whatever_the_session_says(spark, tmp):
    docs = spark.createDataFrame([(i, f"text number {i} of them") for i in range(200)], "doc_id long, text string")
    again = docs.selectExpr("doc_id + 1000 AS doc_id", "text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        index = exact_dedup.DigestIndex(spark, tmp)
        assert exact_dedup.dedup(docs, index).where("kept").count() == 200
        spark.sql(f"DROP TABLE {index.name}")
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        later = exact_dedup.DigestIndex(spark, tmp)
        assert later.buckets == index.buckets
        assert exact_dedup.dedup(again, later).where("kept").count() == 0 and later.read().count() == 200
        later.compact()
        assert later.read().count() == 200 and exact_dedup.DigestIndex(spark, tmp).buckets == index.buckets
        assert exact_dedup.dedup(again, later).where("kept").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    try:
        exact_dedup.DigestIndex(spark, tmp, "string")
        raise AssertionError("another id type was taken")
    except ValueError:
        pass


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", "x  y"), (None, "x  y"), ("d", None)], "doc_id string, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(docs, exact_dedup.new_index(docs)).collect()}
    assert got == {"b": ("c", 4, False), "a": ("c", 4, False), "c": ("c", 4, True), None: ("c", 4, False), "d": ("d", 1, True)}


def test_shards_carry_columns_of_any_name(spark, tmp):
    names = ["_part", "_uid", "_at", "_p", "_cuts", "_block", "_g", "_b", "_n", "_start", "_rank", "row", "part", "a.b", "_first", "_second", "slot"]
    df = spark.createDataFrame([tuple(f"{n}{i}" for n in names) for i in range(50)], ", ".join(f"`{n}` string" for n in names))
    out = sharding.shard(df, 3)
    assert out.columns == [n for n in names if n != "slot"] + ["shard", "slot"]
    rows = out.collect()
    assert sorted(tuple(r)[:16] for r in rows) == sorted(tuple(r)[:16] for r in df.collect())
    sharding.write_shards(df, 3, f"{tmp}/shards", rows_per_file=5)
    assert spark.read.parquet(f"{tmp}/shards").count() == 50


def test_registered_sizes_and_checksums_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = registered.op3_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {
        i: (len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in texts.items()}
    for k in range(8):
        mine = sorted(r.slot for r in got if r.shard == k)
        assert mine == list(range(len(mine))) and abs(len(mine) - len(texts) / 8) < 1


def test_repeated_query_rows_each_get_their_best(spark):
    rows = spark.createDataFrame([(i, [i % 10, i // 10]) for i in range(60)], "id long, v array<long>")
    asked = spark.createDataFrame([(50, [1, 0]), (50, [0, 1]), (50, [1, 0])], "id long, v array<long>")
    for shard in (1000, 16):
        got = [(r.rank, r.vec_id, r.score) for r in topk.search(rows, asked, 2, shard).collect()]
        assert sorted(got) == sorted([(1, 9, 9), (2, 19, 9)] * 2 + [(1, 51, 5), (2, 52, 5)])


def test_a_document_from_two_sources_has_two_places(spark):
    docs = spark.createDataFrame([(1, "t", "s0"), (1, "t", "s1"), (2, "u", None), (2, "u", "s0")], "doc_id long, text string, source string")
    placed = mixing.with_places(docs, {"s0": 1, "s1": 1, mixing.OTHER: 1}, block_rows=1).collect()
    assert len({(r.slot, r.place) for r in placed}) == len(placed) == 4


def test_licence_sample_counts_texts_not_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(licences, "train", seen.append)
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('line of text number ', id % 500) AS text")
    licences.fit(docs, sample_lines=1500)
    assert len(seen[0]) == 500


def test_every_passage_is_learned_from(spark, monkeypatch):
    """A labelled document of 10,000 words whose last passage alone is bad; repeated ids and copies count once."""
    seen = {}
    monkeypatch.setattr(quality, "train", lambda bags, y: seen.update(bags=bags, y=y))
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5]
    long = " ".join(f"word{i}" for i in range(9_980)) + " ## !! $$ %% && ** ||" * 3
    rows = [(ids[0], long), (ids[0], long), (ids[1], "good text here"), (ids[2], "good text here"), (ids[3], None)]
    quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(ids[0], 0), (ids[1], 1), (ids[2], 1), (ids[3], 1)], "doc_id long, quality int"))
    assert sorted(len(b) for b in seen["bags"]) == [1, 1, -(-len(long.split()) // quality.WORDS)]
    bad = max(seen["bags"], key=len)
    assert (bad[-1] != bad[0]).any() and np.allclose(bad, quality.passages(long))
    assert pipeline.STAGES[0][0] == "quality"


def test_scores_equal_a_plain_forward_pass():
    """The attention score, term by term in plain Python, without the batched code."""
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(n, quality.N_FEATURES)).astype(np.float32) for n in (1, 4, 9)] * 8
    model = quality.train(bags, np.array([0, 1, 1] * 8), hidden=5, attention=3, epochs=2)
    p = model.p
    for bag, got in zip(bags, model.scores(bags)):
        h = [np.tanh(((x - model.mean) / model.scale) @ p["W"] + p["b"]) for x in bag]
        e = [sum(p["w"][j] * np.tanh(v @ p["V"][:, j]) / (1 + np.exp(-(v @ p["U"][:, j]))) for j in range(3)) for v in h]
        a = np.exp(e) / np.exp(e).sum()
        z = sum(w * v for w, v in zip(a, h))
        assert abs(got - 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))) < 1e-9


def test_licence_names_are_told_apart():
    m = licences.train([])
    strangers = ["Eclipse Public License, version 2.0", "GNU Free Documentation License", "Licensed under the GNU Free Documentation License.", "Artistic License 2.0",
                 "Released under the Artistic License 2.0.", "This program is released under the", "not released under the MIT License",
                 "This software is not released under the MIT License.", "It is never distributed under the terms of the GNU General Public License.",
                 "MIT and ISC are words in a list of three or more universities.", "Licensing\nthis and that"]
    assert {t: m.scan(t) for t in strangers} == {t: [] for t in strangers}
    said = {"It is MIT licensed.": ["mit"], "Apache 2.0 licensed": ["apache"], "licence: GPL v3": ["gpl"], "SPDX-License-Identifier: (MIT OR Apache-2.0)": ["apache", "mit"],
            "Dual licensed under MIT and GPL": ["gpl", "mit"], "License\n\nMIT": ["mit"]}
    assert {t: sorted(s["family"] for s in m.scan(t)) for t in said} == said


def test_every_statement_and_template_names_its_family_alone():
    m = licences.train([])
    told = [(f, s.format(n)) for f, names in licences.NAMES.items() for n in names for s in licences.STATEMENTS]
    told += [(f, t) for f, texts in licences.TEMPLATES.items() for t in texts]
    assert [(f, t) for f, t in told if {s["family"] for s in m.scan(t)} != {f}] == []
