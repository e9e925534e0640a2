import math
import random
import re

import helpers as h
import pytest
import regex
from pyspark.sql import functions as F

from textloom.llm import pii

PII = [
    "mail a.b+c@x-y.example.com, x@a.b%c@d.e or @no.where a@b", "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255 12.3",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112; 7536784127813050 4845168114407329 9", "call +1 (017) 555-7713 or +12 or +44.20.7946.0958- end+1",
    "é\U0001f600 me@example.org", "7" * 5000, "a" * 20000 + "@", None, "", "0000 0000 0000 0000",
]


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_base_spans_equal_brute_force(spark):
    values = PII + h.texts() + ["1.2.3.4 +44 20 7946 0958 x@y.zz " * 700]
    for r in pii.digest(h.frame(spark, values)).collect():
        expected = h.spans_spec(values[r["doc_id"]])
        assert ",".join(x for x in r["spans"].split(",") if not x.startswith("term")) == ",".join(expected) and r["base_sha256"] == h.sha(",".join(expected))
        assert [r[f"n_{k}"] for k in h.PATTERNS] == [sum(x.startswith(k) for x in expected) for k in h.PATTERNS]


def terms_spec(values, min_texts=3, min_share=0.5, min_g=20.0):
    """Disclosing terms by the definition, over plain sets; ``values`` must not mix texts that share a sentence."""
    units, runs = {}, regex.compile(r"[\p{L}\p{N}]+")
    texts = {t for t in values if t and runs.search(t)}
    for t in texts:
        spans = sorted((int(s), int(e)) for _, s, e in (x.split(":") for x in h.spans_spec(t)))
        out, at, names = [], 0, []
        for s, e in spans:
            if s >= at:
                out += [t[at:s], f" \uE000{len(names)} "]
                names.append(t[s:e])
            at = max(at, e)
        for sentence in re.split(r"[.!?]+[ \t\n\x0b\f\r]+|\n+", "".join([*out, t[at:]])):
            own = frozenset(names[int(k)] for k in re.findall("\uE000([0-9]+)", sentence))
            words = frozenset(w for w in runs.findall(re.sub("\uE000[0-9]+", " ", sentence).lower()) if any(map(str.isalpha, w)))
            units.setdefault((own, words, sentence if not own else ""), min(units.get((own, words, sentence if not own else ""), t), t))
    term, entity = {}, {}
    both = {}
    for (own, words, _), t in units.items():
        for w in words:
            term.setdefault(w, set()).add(t)
            for e in own:
                both.setdefault((w, e), set()).add(t)
        for e in own:
            entity.setdefault(e, set()).add(t)
    n, out = len(texts), set()
    for (w, e), shared in both.items():
        a, x, y = len(shared), len(term[w]), len(entity[e])
        cells = [(a, x, y), (x - a, x, n - y), (y - a, n - x, y), (n - x - y + a, n - x, n - y)]
        g = 2 * sum(o * math.log(o * n / (p * q)) for o, p, q in cells if o)
        if a >= min_texts and a >= min_share * x and a * n > x * y and g >= min_g:
            out.add(w)
    return out


def filler(k):
    return " ".join(f"{w}{k}q{j}" for j, w in enumerate(("red", "blue", "green") * 6))


def disclosure(n_texts=4, plain=1500):
    told = [f"{filler(k)} Zorblax, wrote ann@corp.example.com about {filler(k + 100)}" for k in range(n_texts)]
    copies = [f"{filler(9999)} unique bob@corp.example.com {filler(9998)}"] * 30
    same = ["Copied: mallory at mal@corp.example.com. " + filler(k + 5000) for k in range(20)]
    alone = [". ".join(f"{filler(k + 8000)} selfish eve@corp.example.com {k}" for k in range(9))]
    return told + copies + same + alone + [filler(k + 200) + " about wrote" for k in range(plain)]


@pytest.mark.parametrize("plain", [200, 1100])
def test_a_plant_is_found_at_any_size_and_copies_and_lone_texts_reveal_nothing(spark, plain):
    values = disclosure(plain=plain)
    out = by_id(pii.digest(h.frame(spark, values)), "spans")
    at = values[0].index("Zorblax")
    assert f"term:{at}:{at + 7}" in out[0][0]
    assert {d for d in out if "term" in out[d][0]} == {0, 1, 2, 3}
    terms = pii.disclosing_terms(pii._spanned(pii._renamed(h.frame(spark, values), "text")))
    assert {r["term"] for r in terms.collect()} == terms_spec(values) == {"zorblax"}
    clean = by_id(pii.sanitise(h.frame(spark, values)), "text")
    assert " [TERM], wrote [EMAIL] about " in clean[0][0] and clean[len(values) - 1][0] == values[-1]
    assert all("term" not in s for (s,) in by_id(pii.digest(h.frame(spark, disclosure(2, plain))), "spans").values())


def test_terms_equal_brute_force(spark):
    rng = random.Random(4)
    names, addresses = [f"name{k}" for k in range(12)], [f"a{k}@all.example.org" for k in range(6)] + ["10.0.0.7", "+44 20 7946 0958"]
    values = [filler(k) for k in range(150)]
    for k in range(160):
        said = rng.sample(names, 2) + [rng.choice(addresses) for _ in range(rng.choice((1, 2)))]
        if rng.random() < 0.4:
            said += ["name3", addresses[2]]
        rng.shuffle(said)
        values.append(f"{filler(k + 1000)}. {' '.join(said)} t{k}.\n{filler(k + 2000)}")
    for limits in ({}, {"min_share": 0.2, "min_g": 4.0}, {"min_texts": 1, "min_share": 0.9, "min_g": 0.0}):
        terms = pii.disclosing_terms(pii._spanned(pii._renamed(h.frame(spark, values), "text")), **limits)
        assert {r["term"] for r in terms.collect()} == terms_spec(values, **limits)
    assert terms_spec(values, min_share=0.2, min_g=4.0)


def test_a_common_entity_does_not_hide_a_term_s_own(spark):
    own = [f"{filler(k)} zorblax ann@own.example.org desk@all.example.org {filler(k + 5000)}" for k in range(9)]
    shared = [f"{filler(9)} zorblax wrote desk@all.example.org {filler(5009)}"]
    shared += [f"{filler(k)} desk@all.example.org {filler(k + 5000)}" for k in range(10, 1000)]
    terms = pii.disclosing_terms(pii._spanned(pii._renamed(h.frame(spark, own + shared + [filler(k) for k in range(1000, 3000)]), "text")))
    assert [r["term"] for r in terms.collect()] == ["zorblax"]


def test_many_terms_take_the_joined_way(spark):
    rows = pii._renamed(h.frame(spark, ["Alpha, beta alpha", "gamma", None, "alpha " * 3000]).select("doc_id", "text"), "text")
    terms = spark.createDataFrame([("alpha",), ("gamma",)], "term string")
    show = lambda df: {r["_in_doc__id"]: [tuple(x) for x in r["_term"]] for r in df.collect()}
    expected = {0: [(0, 5), (12, 17)], 1: [(0, 5)], 2: [], 3: [(6 * k, 6 * k + 5) for k in range(3000)]}
    assert show(pii.with_term_spans(rows, terms, set_terms=1)) == show(pii.with_term_spans(rows, terms)) == expected


def test_nothing_is_left_and_other_columns_stay(spark):
    values = ["call +1 (826) 555-4081 10.1.2.3 now", "+1 (826) 555-4081 10.1.2.3 4111 1111 1111 1111", "4111 1111 1111 1111 4111-1111-1111-1111 9", *PII]
    rows = h.frame(spark, values).withColumns({c: F.lit(c) for c in ("_text", "_base", "_term", "_all", "_h", "a.b", "personal_data")})
    out = pii.sanitise(rows)
    assert out.columns == rows.columns
    for r in out.collect():
        assert not h.spans_spec(r["text"]) and all(r[c] == c for c in ("_text", "_base", "_term", "_all", "_h", "a.b", "personal_data"))
        assert h.spans_spec(values[r["doc_id"]]) or r["text"] == values[r["doc_id"]]
    found = pii.find_personal_data(rows)
    assert found.columns[-1] == "personal_data" and found.where("size(personal_data.email) > 0").count() > 0
