import math
import random
import re
import zlib
from types import SimpleNamespace

import helpers as h
import numpy as np
import pytest
from compare import assert_same, oracle
from pyspark.sql import functions as F

from textloom.llm import common, decontamination, language_id, licences, mixing, quality_classifier, quality_rules, queries, simhash, url_filters


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return h.frame(spark, h.texts()).repartition(5, "doc_id").cache()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, name):
    assert_same(queries.QUERIES[name](spark, sf), oracle(sf, queries.ORACLE_SQL[name]))


@pytest.mark.parametrize("block_bytes", [4_000_000, 60])
def test_overlaps_equal_brute_force(spark, docs, block_bytes):
    passage = h.texts()[30].split()
    items = [(1, " ".join(passage[:20])), (2, " ".join(passage[5:14]).upper()), (3, "the of"), (4, None), (5, ""), (1, "re"), (7, " ".join(passage[10:18])), (8, "(" + " ".join(passage[:12]))]
    given = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_overlaps(docs.select("doc_id", "text"), given, block_bytes=block_bytes)
    got = found.select("doc_id", "n_words", F.size("items"), F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"]), F.concat_ws(",", F.sort_array("items")))
    expected = h.hits_spec(enumerate(h.texts()), items)
    assert {r[0]: (r[1], r[3], r[2], h.sha(r[4]), r[2] >= 2) for r in got.collect()} == expected
    assert any(e[1] for e in expected.values())
    if block_bytes > 60:
        assert by_id(decontamination.digest(docs, given), "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected


def test_spans_are_cut_and_the_rest_stays(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    rows = h.frame(spark, ["Start, " + " ".join(f"w{i}" for i in range(30)) + " (Alpha beta gamma; delta epsilon zeta eta THETA)! é end", item, None, "clean é text"])
    out = by_id(decontamination.remove_overlaps(rows, spark.createDataFrame([(1, item)], "item_id long, text string")), "text")
    assert out[0][0].endswith("w29 ()! é end") and out[0][0].startswith("Start, w0")
    assert 1 not in out and out[2] == (None,) and out[3] == ("clean é text",)


@pytest.mark.parametrize("block_bytes", [4_000_000, 60])
def test_cutting_passes_texts_through_python_once_and_cuts_batches_of_many_rows(spark, block_bytes):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "iota kappa lambda mu nu xi omicron pi rho"), (3, "v1 v2")]
    own = lambda k: f"w{k} é " * 6
    kinds = [lambda k: (own(k) + f"({items[k % 2][1].upper()})! é", own(k) + "()! é"), lambda k: (items[k % 2][1] + f" w{k}", None), lambda k: (None, ""), lambda k: (own(k) + "v1 v2",) * 2]
    pairs = [kinds[k // 700 if k < 2100 else k % 4](k) for k in range(2800)]
    rows = h.frame(spark, [t for t, _ in pairs]).coalesce(1)
    cut = decontamination.remove_overlaps(rows, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = [(r["doc_id"], r["text"] or "") for r in cut.collect()]
    assert sorted(got) == [(k, t) for k, (_, t) in enumerate(pairs) if t is not None]


def test_components_equal_brute_force(docs):
    fps = {d: h.fingerprint_spec(t) for d, t in enumerate(h.texts())}
    roots = h.components_spec(fps)
    expected = {d: (f"{fps[d]:016x}", roots[d]) for d in fps}
    assert by_id(simhash.simhash_components(docs), "fingerprint", "component_id") == expected
    assert len(set(roots.values())) < len(roots)


def test_masks_cover_every_pair_of_bits():
    masks = [m % (1 << 64) for m in simhash.covering_masks()]
    for i in range(64):
        for j in range(64):
            assert any(not (m >> i & 1 or m >> j & 1) for m in masks)


@pytest.mark.parametrize("small_bucket", [64, 3])
def test_large_buckets_link_as_small_ones(spark, small_bucket):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(4)]
    fps = {c for c in centres} | {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(25)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    edges = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "_fp long"), small_bucket=small_bucket)
    got = {r["node"]: r["root"] for r in common.connected_components(edges).collect()}
    expected = h.components_spec({f: f % (1 << 64) for f in signed})
    assert all(got.get(f, f) == expected[f] for f in signed)


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    random.Random(0).shuffle(chain)
    got = {r["node"]: r["root"] for r in common.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(docs):
    kept = {r[0] for r in simhash.drop_near_duplicates(docs).select("doc_id").collect()}
    values = h.texts()
    roots = h.components_spec({d: h.fingerprint_spec(t) for d, t in enumerate(values)})
    assert kept == {d for d in roots if roots[d] == d or not h.WORD.search(values[d] or "")}


def test_rules_equal_brute_force(docs):
    got = by_id(quality_rules.digest(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for d, t in enumerate(h.texts()):
        assert got[d][:6] == h.rules_spec(t)
        assert not (got[d][5] and got[d][6])


def test_divergence_keeps_prose_and_drops_noise(spark, sf):
    rows = common.read(spark, sf, "documents")
    judged = quality_rules.judge(rows.select("doc_id", "lang", "text")).join(common.read(spark, sf, "labels"), "doc_id").where("not base_failed")
    r = judged.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()
    share = {x["quality"]: x["k"] for x in r}
    assert share[1] == 1.0 and share.get(0, 0.0) < 0.3
    same = F.array(F.lit(1), F.lit(3))
    assert spark.range(1).select(quality_rules.distance(same, F.lit(4), same, F.lit(4))).first()[0] == 0.0
    apart = [F.array(F.lit(1), F.lit(0)), F.array(F.lit(0), F.lit(1))]
    assert spark.range(1).select(quality_rules.distance(apart[0], F.lit(1), apart[1], F.lit(1))).first()[0] == pytest.approx(1.0)


def prose(rng, lists, n):
    """Words of which a third are common ones of the languages ``lists``, in sentences."""
    words = [rng.choice(quality_rules.COMMON[12 * rng.choice(lists) :][:12]) if rng.random() < 0.33 else "".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if k % 12 == 11 else w for k, w in enumerate(words))


def test_junk_is_found_where_a_language_is_mostly_junk_or_has_no_other_text(spark):
    rng = random.Random(9)
    junk = lambda: " | ".join("".join(rng.choices("etaoinshrdlu", k=3)).upper() + "%$#" for _ in range(300))
    good = [(prose(rng, [0], 300), "en") for _ in range(60)] + [(prose(rng, [2], 300), "de") for _ in range(40)]
    rare = [(prose(rng, [1], 300), "fr") for _ in range(5)]
    mixed = [(prose(rng, [0, 2], 400), "en") for _ in range(5)]
    bad = [(junk(), "fr") for _ in range(95)] + [(junk(), "es")]
    rows = [(k, t, lang, "x", "y") for k, (t, lang) in enumerate(good + rare + mixed + bad)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, _prose string, kept string")
    out = quality_rules.judge(given)
    assert out.columns[:3] == ["doc_id", "lang", "_prose"] and out.columns.count("kept") == 1
    kept = {r["doc_id"]: (r["kept"], r["_prose"]) for r in out.collect()}
    assert [kept[k] for k in range(110)] == [(True, "x")] * 110 and [kept[k] for k in range(110, len(rows))] == [(False, "x")] * 96
    alone = quality_rules.judge(given.where("lang = 'es'")).first()
    assert not alone["kept"] and alone["common_distance"] is None


def test_mix_meets_its_targets(spark):
    values = ["w " * (5 + k % 40) for k in range(300)] + [None, ""]
    rows = h.frame(spark, values, source=lambda k: None if k % 10 == 0 else "tiny" if k % 50 == 1 else "big" if k % 3 else "mid")
    out = mixing.mix(rows).toPandas()
    assert (out["taken"] <= 3 * out["size"]).all()
    per = out.groupby("source", dropna=False).agg(t=("taken", "sum"), target=("target", "first"), s=("source_size", "first"), n=("size", "sum"))
    assert ((per["t"] - per["target"]).abs() <= 2).all() and (per["s"] == per["n"]).all()
    assert per["target"].sum() == pytest.approx(per["n"].sum()) and (per["target"] <= 3 * per["s"] + 1e-6).all()
    assert per.loc["tiny", "target"] < 3 * per.loc["tiny", "s"] + 1e-6
    again = mixing.mix(rows.repartition(7)).toPandas()
    assert out.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()


def test_repeated_ids_share_the_threshold(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", "x")] * 4 + [(2, "a", "y")], "doc_id long, text string, source string")
    out = mixing.mix(rows).where("source = 'x'").toPandas()
    assert abs(out["taken"].sum() - out["target"].iloc[0]) <= 4 and out["taken"].nunique() == 1


def statistics_spec(t):
    w, n = h.BYTES.findall((t or "").encode()), len(h.BYTES.findall((t or "").encode()))
    raw = (t or "").encode()
    if not n:
        return [0.0] * 14
    count = lambda p: len(re.findall(p, raw))
    lines = [x.strip() for x in raw.split(b"\n") if x.strip()]
    marks = rb"[!-/:-@\[-`{-~]"
    return [
        math.log(n), math.log(sum(map(len, w)) / n), math.sqrt(count(rb"[A-Z]") / max(1, count(rb"[A-Za-z]"))), math.sqrt(count(rb"[#*$%&|<>]") / n),
        math.sqrt(count(rb"!") / n), math.sqrt(count(rb"[.!?]") / n), math.sqrt(count(marks) / n), math.sqrt(count(rb"[0-9]") / len(raw)),
        math.sqrt((len(raw) - len(t)) / len(raw)), math.sqrt(sum(a == b for a, b in zip(w, w[1:], strict=False)) / n), math.log(len(set(w))) / math.log(n + 1),
        math.sqrt(1 - len(set(lines)) / max(1, len(lines))), math.log(n / max(1, len(lines))), math.sqrt(sum(bool(re.fullmatch(marks, x)) for x in w) / n),
    ]


def test_scores_equal_the_densities_written_out(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = common.read(spark, sf, "documents"), common.read(spark, sf, "labels")
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 2
    texts = {r["doc_id"]: statistics_spec(r["text"]) for r in docs.collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None and not held(r["doc_id"]) and r["doc_id"] in texts}
    x, y = np.array([texts[d] for d in known]), np.array(list(known.values()))
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-3)
    ratios = []
    for k in (1, 0):
        own = z[y == k]
        cov = 0.9 * np.cov(own.T, bias=True) + 0.1 * np.eye(14)
        gone = {d: (np.array(v) - x.mean(axis=0)) / (x.std(axis=0) + 1e-3) - own.mean(axis=0) for d, v in texts.items()}
        ratios.append({d: -0.5 * g @ np.linalg.solve(cov, g) - 0.5 * np.linalg.slogdet(cov)[1] for d, g in gone.items()})
    ratio = {d: ratios[0][d] - ratios[1][d] for d in texts}
    model = quality_classifier.train(docs, labels, ~quality_classifier.held_out(F.col("doc_id")))
    assert model.slope > 0
    got = by_id(queries.QUERIES["op9_quality_classifier"](spark, sf), "score", "held_out", "predicted")
    for d, (score, out, predicted) in got.items():
        assert score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, model.slope * ratio[d] + model.offset)))), rel=1e-6, abs=1e-9)
        assert out == held(d) and predicted == (score >= 0.7)


def test_calibration_is_the_best_logistic_curve():
    rng = np.random.default_rng(3)
    r, y = rng.normal(0, 3, 400), None
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.7 * r + 0.4)))).astype(int)
    a, b = quality_classifier._calibration(r, y)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    p = lambda a, b: 1 / (1 + np.exp(-(a * r + b)))
    loss = lambda a, b: -(target * np.log(p(a, b)) + (1 - target) * np.log(1 - p(a, b))).sum()
    assert all(loss(a, b) <= loss(a + da, b + db) + 1e-9 for da in (-0.01, 0, 0.01) for db in (-0.01, 0, 0.01))


def test_answers_equal_a_plain_forward_pass(spark):
    docs = h.frame(spark, [*h.texts(40), "é" * 700, "a" * 100_000, "w " * 30_000], lang="en").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("xx"))
    net = language_id.train(docs, F.lit(True), max_docs=30, steps=40)
    got = by_id(language_id.predict(docs.select("doc_id", "text"), net), "lang_pred", "score")
    for d, t in enumerate([*h.texts(40), "é" * 700, "a" * 100_000, "w " * 30_000]):
        raw = (t or "").encode()
        if not any(map(str.isalpha, t or "")):
            assert got[d] == ("und", 0.0)
            continue
        total = np.zeros(len(net.langs))
        for at in range(0, min(len(raw), 4_000) if d == 41 else len(raw), language_id.WINDOW):
            window = raw[at : at + language_id.WINDOW]
            x = net.embed[np.frombuffer(window.ljust(language_id.WINDOW, b"\0"), np.uint8)]
            pooled = [max(0.0, max(float((x[i : i + w] * f[:, :, j]).sum()) for i in range(len(x) - w + 1)) + net.bias[own * language_id.FILTERS + j]) for own, (w, f) in enumerate(zip(language_id.WIDTHS, net.filters, strict=True)) for j in range(language_id.FILTERS)] if d < 12 else list(np.maximum(net.pooled(np.frombuffer(window.ljust(language_id.WINDOW, b"\0"), np.uint8)[None], net.tables())[0][0], 0))
            total += len(window) * (np.array(pooled) @ net.dense + net.dense_bias)
        if d == 41:
            continue
        p = np.exp(total / len(raw) - (total / len(raw)).max())
        assert got[d][0] == net.langs[int(p.argmax())] and got[d][1] == pytest.approx(p.max() / p.sum(), rel=1e-3)


def test_seventy_languages_are_all_learned(spark):
    rng = random.Random(2)
    words = {k: ["".join(rng.choices(rng.sample("abcdefghijklmnopqrstuvwxyz", 5), k=6)) for _ in range(30)] for k in range(70)}
    given = [(k * 10 + j, " ".join(rng.choices(words[k], k=60)), f"l{k:02}") for k in range(70) for j in range(8)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
    net = language_id.train(docs, F.lit(True), steps=200)
    assert len(net.langs) == 70
    assert {r["lang"]: r["n"] for r in language_id.sample(docs, F.lit(True), 5).groupBy("lang").agg(F.count("*").alias("n")).collect()} == {f"l{k:02}": 5 for k in range(70)}
    out = by_id(language_id.predict(docs.select("doc_id", "text"), net), "lang_pred")
    assert np.mean([out[d] == (lang,) for d, _, lang in given]) > 0.8


def test_quality_scores_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op9_quality_classifier"](spark, sf).join(common.read(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out["quality"]).mean() > 0.95 and out["score"].between(0, 1).all()
    assert ((out["score"] >= 0.7).astype(int) == out["predicted"]).all()


def test_classifier_with_odd_labels(spark):
    rows = h.frame(spark, ["good text here", None, ""] + ["other words " * 9] * 3)
    for labels in ([], [(0, 1), (1, None)], [(0, 1), (3, 1), (None, 0)]):
        out = quality_classifier.digest(rows, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)


def test_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op8_language_id"](spark, sf).join(common.read(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.97 and out["score"].between(0, 1).all()


def test_convolution_equals_its_tables():
    rng = np.random.default_rng(0)
    net = language_id.fit(np.zeros((0, language_id.WINDOW), np.uint8), np.zeros(0, np.int64), ["a", "b"])
    windows = rng.integers(0, 256, (3, language_id.WINDOW)).astype(np.uint8)
    pooled, _ = net.pooled(windows, net.tables())
    for i, width in enumerate(language_id.WIDTHS):
        x = np.stack([net.embed[windows[:, j : language_id.WINDOW - width + 1 + j]] for j in range(width)], axis=2)
        plain = np.einsum("ntwe,wef->ntf", x, net.filters[i]).max(axis=1)
        own = slice(i * language_id.FILTERS, (i + 1) * language_id.FILTERS)
        assert np.allclose(pooled[:, own], plain, atol=1e-4)


def test_language_edge_cases(spark):
    rows = h.frame(spark, [None, "", "12 34 !?", "é", "words of text"] * 3)
    out = by_id(language_id.digest(rows), "lang_pred", "score")
    assert [out[d] for d in range(3)] == [("und", 0.0)] * 3 and out[3][0] == out[4][0] == "en"
    none = language_id.digest(rows.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_licence_sequences(spark):
    grant, notice = licences.SENTENCES["mit-grant"], licences.SENTENCES["mit-notice"]
    near, far = "Other. More. ", "Other. More. Still more. "
    rows = h.frame(spark, [f"{grant.upper()}. {near}{notice}.", f"{grant}. {far}{notice}.", "Released under the MIT License.\nAll rights reserved.", None, "", "MIT License", f"{notice}. {grant}."])
    out = by_id(licences.digest(rows), "rules", "licences", "licence")
    assert out[0] == ("mit-full,mit-grant", "MIT", "MIT") and out[1] == ("mit-grant", "MIT", "MIT")
    assert out[2] == ("mit-name,reserved", "MIT,Proprietary", "MIT") and out[6][0] == "mit-grant"
    assert out[3] == out[4] == out[5] == ("", "", None)


def test_entries_hold_between_their_days(spark):
    entries = spark.createDataFrame([("Bad.example", "x", "add", "2024-01-10"), ("bad.example", "x", "add", "2024-01-10"), ("bad.example", "x", "remove", "2024-02-01"), ("odd.example", "x", "add", "2024-01-01"), ("odd.example", "x", "remove", "2024-01-01")], "domain string, category string, action string, day string")
    urls = ["https://www.BAD.example:8080/a?b", "http://u@bad.example./", "http://notbad.example/", "/relative", None, "", "http://odd.example"]
    days = ["2024-01-09", "2024-01-10", "2024-01-31", "2024-02-01", None]
    rows = spark.createDataFrame([(u, d, 1) for u in urls for d in days], "url string, fetch_time string, host int").drop("host")
    out = {(r["url"], r["fetch_time"]) for r in url_filters.evaluate(rows, entries).collect() if r["blocked"]}
    assert out == {(u, d) for u in urls[:2] for d in days[1:3]}
    assert url_filters.evaluate(rows, entries.limit(0)).where("blocked").count() == 0


def test_split_joins_equal_broadcast_ones(spark):
    big = spark.createDataFrame([(k, None if k % 3 == 0 else "a" if k % 3 == 1 else "zz") for k in range(90)], "i long, k string")
    small = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi"):
        a, b, c = (common.join_small(big, small, "k", how, limit=n, hot_rows=hot).collect() for n, hot in ((10, 1), (1, 1), (1, 1000)))
        assert sorted(map(str, a)) == sorted(map(str, b)) == sorted(map(str, c))


def test_scratch_is_shared_and_deleted(spark):
    table = common.stored(spark.range(3))
    common.discard(table)
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(table._scratch)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="share"):
        common.shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))


NAMES = [*queries.QUERIES]


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tmp_path, name):
    tables = {"documents": h.DOCUMENT, "benchmark": "item_id long, text string", "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string"}
    for table, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_nulls_repeats_long_texts_and_clashing_names(spark, tmp_path, name):
    values = [None, "", "x", "the of and to " * 40, "é" * 5000, "word " * 40_000, "y" * 200_000] + h.texts(20)
    given = [(None if k % 7 == 3 else k // 2, t, None if k % 3 else "en", None if k % 4 else "s", None, k, "x", "h") for k, t in enumerate(values * 2)]
    schema = h.DOCUMENT + ", size int, score string, _text string"
    spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, None), (1, None), (None, "x"), (2, "the of and to the of and to the")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 1, 0), (2, 0, 1), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    pages = [(None if k % 5 == 0 else k // 2, "http://casino-win.example.com/" if k % 2 else None, None, "x") for k in range(len(given))]
    spark.createDataFrame(pages, "page_id long, url string, html string, matched string").write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == len(given)


CLASHES = ("_text", "_hits", "_items", "_n_words", "_size", "_hash", "_source", "_k", "_plan_target", "_day", "_key", "_host", "_h", "_fp", "_score", "_codes", "_in_text", "a.b")


def test_callers_columns_of_any_name_pass_through(spark):
    rows = h.frame(spark, ["good text here of some words " * 4, None, "all rights reserved"]).withColumns({c: F.lit(c) for c in CLASHES})
    items = spark.createDataFrame([(1, "good text here")], "item_id long, text string")
    net = language_id.train(rows, F.lit(True), steps=5)
    model = quality_classifier.train(rows, spark.createDataFrame([(0, 1)], "doc_id long, quality int"), F.lit(True))
    captures = rows.withColumns({"url": F.lit("http://casino-win.example.com/x"), "fetch_time": F.when(F.col("doc_id") == 1, "no time").otherwise("2024-05-01"), "matched": F.lit("old")})
    made = {
        "overlaps": decontamination.find_overlaps(rows, items), "cut": decontamination.remove_overlaps(rows, items), "blocks": decontamination.find_overlaps(rows, items.union(items), block_bytes=5),
        "mix": mixing.mix(rows), "urls": url_filters.evaluate(captures, url_filters.fixed_list(spark)), "licences": licences.scan(rows), "fps": simhash.with_fingerprints(rows, added="fp"),
        "one": simhash.drop_near_duplicates(rows), "lang": language_id.predict(rows, net), "scores": quality_classifier.with_scores(rows, model), "rules": quality_rules.judge(rows),
    }
    for name, df in made.items():
        out = df.collect()
        assert out and all(r[c] == c for r in out for c in CLASHES), name
    assert {r["doc_id"]: r["matched"] for r in made["urls"].collect()} == {0: "casino-win.example.com:gambling", 1: "", 2: "casino-win.example.com:gambling"}


def test_rows_that_share_an_id_but_no_text_all_stay(spark):
    rows = spark.createDataFrame([(1, "some words of one"), (1, "quite another text here"), (2, "third thing altogether now"), (3, "some words of one"), (None, "x y"), (4, None)], "doc_id long, text string")
    out = sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.drop_near_duplicates(rows).collect())
    assert (2, "third thing altogether now") in out and (0, "x y") in out and (4, "") in out and (3, "some words of one") not in out
    assert (1, "some words of one") in out or (1, "quite another text here") in out
