"""Personal data: patterns against plain ones, disclosure against brute force."""

import hashlib
import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from roadcast.llm import private

SCHEMA = "doc_id long, text string"


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    odd = [int(c) for c in reversed(text)]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(odd)) % 10 == 0


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern, passes in RULES
        for m in re.finditer(pattern, text or "")
        if passes(m[0])
    ]


TEXTS = [
    None,
    "",
    "a@b.c",
    "x a@b a@b.cd+e@f.g .@x.y..z é😀q@w.e",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 00000000000000000000255.1.1.001 1.2.3",
    "build 1.2.3.2024 10.0.19045.3803 1.22.333.4444 55555.6.7.8 " + " ".join("1.2.3." + "7" * n for n in range(1, 13)),
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111 4111  1111 1111 1111 1",
    "+1 (555) 123-4567 +12 +1 2 +49.30.1234567. ++1 555 123 4567 +1 555 123 4567 8901 2345",
    "12 34 " * 20 + "4111111111111111",
    "a" * 50_000 + "@" + "b." * 20_000 + "c",
    "9" * 30_000,
    "+" + "1-" * 30_000,
]


def test_spans_against_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA).withColumn("found", F.lit(0))
    rows = private.report(private.protected(docs)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = brute(TEXTS[r.doc_id])
        written = ",".join("%s:%d:%d" % s for s in want)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert r.spans.startswith(written)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[0] == k for s in want) for k in private.KINDS
        ]


PARTS = st.one_of(
    st.text("a1+@. -9é(2", max_size=40),
    st.lists(st.sampled_from(["1", "255", "256", "2024", ".", ".", " ", "-", "+", "@", "a", "4111", "é"]), max_size=20).map("".join),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(PARTS, min_size=400, max_size=400))
def test_spans_of_any_text(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA).select(
        "doc_id", private.mentions(F.col("text")).alias("found")
    )
    for r in rows.collect():
        assert [(s.kind, s.start, s.end) for s in r.found] == brute(texts[r.doc_id])


EMAIL = re.compile(RULES[0][1])


def corpus():
    near = "Heribert Zumwalt, of project Nightjar, had mail about {} " + "and so on to the end of a long line " * 4 + "to hz@firm.example"
    rows = [near.format(f"word{chr(97 + i)}{chr(97 + i)}") for i in range(6)]
    rows += ["the project about nothing, mail about the weather or else " * 3 + f"tale {i}" for i in range(60)]
    rows += [f"project about mail to p{i}@firm.example and so on to the end of a long line or else nothing then {i}" for i in range(20)]
    rows += [rows[0]] * 5 + [None, "", "unica vocable near lone@firm.example here"]
    # A name as first and as last word, of three letters, and a passage that documents share.
    rows += [f"Wilhelmina: wm@corp.example wrote note number {i} of {i * 7}" for i in range(9)]
    rows += [f"tale {i} goes on to wm@corp.example Wilhelmina" for i in range(60, 70)] + ["Wilhelmina came alone"]
    rows += [f"{i} calls +1 (555) 123-45{i:02} for Li or 10.0.0.{i % 4}" for i in range(10, 60)]
    return list(enumerate(rows))


def terms_of(text):
    return {w.lower() for w in re.findall(r"(?<![^\W_])[^\W\d_]{2,}(?![^\W_])", EMAIL.sub(" ", text or "") if "@" in (text or "") else text or "")}


def entities_of(text):
    out = set()
    for kind, start, end in brute(text):
        value = text[start:end]
        out.add(kind + ":" + (value.lower() if kind == "email" else value if kind == "ip" else digits(value)))
    return out


def brute_disclosing(rows):
    """Terms that give away at least 0.9 of what an entity holds, and not by chance."""
    texts = {text or "" for _, text in rows}
    n_term, n_entity, both = Counter(), Counter(), Counter()
    for text in texts:
        terms, entities = terms_of(text), entities_of(text)
        n_term.update(terms)
        n_entity.update(entities)
        both.update((c, t) for c in entities for t in terms)
    n = len(texts)
    return {
        (c, t)
        for (c, t), k in both.items()
        if k > 1
        and n > n_entity[c]
        and k * math.log(n / n_entity[c]) >= -math.log(1e-6)
        and math.log(k * n / (n_entity[c] * n_term[t])) >= 0.9 * math.log(n / n_entity[c])
    }


def brute_withheld(text, told):
    mentions = brute(text)
    asked = {t for c, t in told if c in entities_of(text)}
    return [
        (m.start(), m.end())
        for m in re.finditer(r"[^\W_]+", text or "")
        if m[0].lower() in asked and not any(s < m.end() and m.start() < e for _, s, e in mentions)
    ]


def test_terms_that_reveal_an_entity_are_withheld(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    told = brute_disclosing(rows)
    assert {t for c, t in told if "hz@" in c} >= {"heribert", "zumwalt", "nightjar"}
    assert ("email:wm@corp.example", "wilhelmina") in told
    assert not {t for _, t in told} & {"project", "about", "else", "vocable", "the", "li"}
    found = private.protected(docs.repartition(4))
    got = sorted((r.doc_id, [(s.start, s.end) for s in r.withheld]) for r in found.collect())
    assert got == [(i, brute_withheld(t, told)) for i, t in rows]
    clean = {
        r.doc_id: (r.text, r.clean)
        for r in found.join(docs, "doc_id")
        .select("doc_id", "text", private.sanitised(F.col("text"), F.col("found"), F.col("withheld")).alias("clean"))
        .collect()
    }
    for text, left in clean.values():
        for term, entity in (("Heribert", "hz@"), ("Zumwalt", "hz@"), ("Wilhelmina", "wm@")):
            assert entity not in (text or "") or term not in left
    assert clean[0][1].startswith(" , of project ") and clean[7][1] == rows[7][1]
    alone = next(i for i, t in rows if t == "Wilhelmina came alone")
    assert clean[alone][1] == "Wilhelmina came alone"  # it mentions nobody


def test_entities_without_a_measurable_term_are_counted(spark):
    rows = corpus()
    row = private.unmeasured(private.scanned(spark.createDataFrame(rows, SCHEMA))).first()
    counts = Counter(c for t in {t for _, t in rows} for c in entities_of(t))
    assert tuple(row) == (len(counts), sum(n == 1 for n in counts.values()))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "x y@z.w"), (None, "x y@z.w")]])
def test_edges(spark, rows):
    assert private.report(private.protected(spark.createDataFrame(rows, SCHEMA))).count() == len(rows)
