"""Personal data, and the words that give it away.

Patterns find e-mail and IP addresses, card and phone numbers. Each distinct value is a
protected entity. From the whole corpus, co-occurrence in documents tells how strongly a
term reveals an entity: of ``N`` documents, ``n(t)`` hold the term t, ``n(c)`` mention the
entity c and ``n(c, t)`` do both. The information t gives about c is

    PMI(c, t) = log(n(c, t) * N / (n(c) * n(t)))

and c itself holds ``IC(c) = log(N / n(c))``. A term that gives at least ``DISCLOSED`` of
that is withheld wherever it stands in a document that mentions c, unless chance explains
it: were the term's documents any documents, ``n(c, t)`` of them would all mention c with
a probability of ``(n(c) / N) ** n(c, t)``, which must be below ``CHANCE``, and two must.
So entities in a single document have no measurable term (`unmeasured` counts them).
Documents of equal text count as one. `sanitised` replaces entities by their kind and
removes withheld terms.

Terms are whole words of at least two letters, lower-cased, outside e-mail addresses. The
patterns take possessive repeats and look-behinds that change no match but keep the search
linear.

Defined results: a null text is empty. Rows that repeat an id are separate documents;
where they repeat the text, too, all show the same. Other columns are ignored. Everything
is column functions; broadcast are bitmaps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.llm.bitmaps import bitmap, maybe_in, surely_out
from roadcast.llm.spans import listed, matches, of_kind
from roadcast.llm.tables import settle
from roadcast.operators.joins import skewproof_join

KINDS = ("email", "ip", "card", "phone")
DISCLOSED = 0.9
CHANCE = 1e-6

# A match may begin where the run of its first characters does, or where the last match
# ended inside that run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Shorter chains of digits cannot pass, and hold no longer ones.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"(?<![\p{L}\p{N}])\p{L}{2,}+(?![\p{L}\p{N}])"
RUN = r"[\p{L}\p{N}]+"  # in which a term is a whole one


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the checksum, counted from the last."""
    backwards = F.split(F.reverse(_digits(value)), "")
    summed = F.aggregate(
        F.transform(
            backwards,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.floor(d.cast("int") / 5).cast("int") + d.cast("int") * 2 % 10
            ),
        ),
        F.lit(0),
        lambda a, d: a + d,
    )
    return summed % 10 == 0


def _small_parts(value: Column) -> Column:
    """Whether every number between the dots is at most 255."""
    return F.forall(
        F.split(value, r"\."),
        lambda p: F.coalesce(F.regexp_extract(p, "^0*([0-9]{1,3})$", 1).try_cast("int") <= 255, F.lit(False)),
    )


def mentions(text: Column) -> Column:
    """The personal data in a text, by kind and place."""
    n = F.char_length
    return F.concat(
        matches(text, EMAIL, "email", needs="@"),
        F.filter(matches(text, IP, "ip", needs="."), lambda s: _small_parts(s["value"])),
        F.filter(
            matches(text, CARD, "card"),
            lambda s: n(_digits(s["value"])).between(13, 19) & _luhn(s["value"]),
        ),
        F.filter(
            matches(text, PHONE, "phone", needs="+"), lambda s: n(_digits(s["value"])).between(9, 15)
        ),
    )


def _entity(mention: Column) -> Column:
    """The value behind a mention, whatever way it is written."""
    value = F.when(mention["kind"] == "email", F.lower(mention["value"])).when(
        mention["kind"] == "ip", mention["value"]
    )
    return F.concat_ws(":", mention["kind"], value.otherwise(_digits(mention["value"])))


def _terms(text: Column) -> Column:
    """The distinct terms of a text."""
    bare = F.when(text.contains("@"), F.regexp_replace(text, EMAIL, " ")).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(bare, F.lit(TERM), F.lit(0)), F.lower))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, row, print`` (of the text), ``found`` (mentions),
    and the distinct ``entities`` and ``terms``. ``row`` tells rows apart."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", mentions(F.col("text")).alias("found"))
    return rows.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64("text").alias("print"),
        F.transform("found", lambda m: F.struct(m["kind"], m["start"], m["end"])).alias("found"),
        F.array_distinct(F.transform("found", _entity)).alias("entities"),
        _terms(F.col("text")).alias("terms"),
    )


def _one_of_each_text(scan: DataFrame) -> DataFrame:
    """The scan without the rows that repeat a text; the others are not shuffled."""
    rows = scan.select("row", "print")
    repeated = rows.groupBy("print").agg(F.min("row").alias("kept"), F.count("*").alias("n")).filter("n > 1")
    copies = skewproof_join(rows, repeated, ["print"], "inner").filter("row <> kept").select("row")
    copies = settle(copies, "copies-of-texts")
    pages = bitmap(copies, "row")
    return surely_out(scan, "row", pages).unionByName(
        maybe_in(scan, "row", pages).join(copies, "row", "left_anti")
    )


def disclosing(scan: DataFrame, disclosed: float = DISCLOSED, chance: float = CHANCE) -> DataFrame:
    """The terms that reveal an entity: ``entity, term``. All counts are over the whole
    corpus."""
    texts = _one_of_each_text(scan.select("row", "print", "entities", "terms"))
    n_all = float(texts.count() or 1)
    mentioning = texts.filter(F.size("entities") > 0)
    near = mentioning.select("row", F.explode("terms").alias("term"))
    words = texts.select(F.explode("terms").alias("term"))
    counted = maybe_in(words, "term", bitmap(near, "term")).groupBy("term").agg(F.count("*").alias("n_term"))
    counted = settle(counted.filter("n_term > 1"), "term-counts")
    told = mentioning.select("row", F.explode("entities").alias("entity"))
    entities = settle(told.groupBy("entity").agg(F.count("*").alias("n_entity")).filter("n_entity > 1"), "entity-counts")
    # A term in so many documents cannot give enough, even if all that mention c hold it.
    at_most = F.col("n_entity") * F.pow(F.lit(n_all) / F.col("n_entity"), F.lit(1 - disclosed)) * (1 + 1e-9)
    rare = skewproof_join(near, counted, ["term"], "inner")
    sides = skewproof_join(told, entities, ["entity"], "inner").join(rare, "row")
    pairs = sides.filter(F.col("n_term") <= at_most).groupBy("entity", "term", "n_entity", "n_term")
    both = pairs.agg(F.count("*").alias("n_both"))
    holds = F.log(F.lit(n_all) / F.col("n_entity"))
    gives = F.log(F.col("n_both") * F.lit(n_all) / (F.col("n_entity") * F.col("n_term")))
    sure = (F.col("n_both") > 1) & (F.col("n_both") * holds >= -math.log(chance))
    return both.filter((holds > 0) & sure & (gives >= disclosed * holds)).select("entity", "term")


def unmeasured(scan: DataFrame) -> DataFrame:
    """How many entities there are, and how many of them no term can be measured for, as
    one text alone mentions them: ``entities, unmeasured``."""
    texts = _one_of_each_text(scan.select("row", "print", "entities"))
    counts = texts.select(F.explode("entities").alias("entity")).groupBy("entity").count()
    return counts.agg(F.count("*").alias("entities"), F.count_if(F.col("count") == 1).alias("unmeasured"))


def _withheld(docs: DataFrame, scan: DataFrame, told: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Where the terms stand that reveal what their document mentions: ``doc_id, print,
    withheld``."""
    rows = scan.filter(F.size("entities") > 0)
    here = maybe_in(rows.select("row", F.explode("terms").alias("term")), "term", bitmap(told, "term"))
    pairs = rows.select("row", F.explode("entities").alias("entity"))
    asked = here.join(pairs, "row").join(told, ["entity", "term"], "left_semi").groupBy("row").agg(F.collect_set("term").alias("asked"))
    asked = settle(
        rows.select("row", "doc_id", "print", "found").join(asked, "row").select("doc_id", "print", "found", "asked"),
        "terms-to-withhold",
    )
    texts = docs.select(F.col(id_col).alias("t_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = maybe_in(texts.withColumn("t_print", F.xxhash64("text")), "t_print", bitmap(asked, "print"))
    once = ["doc_id", "print"]
    one = asked.groupBy(*once).agg(F.first("found").alias("found"), F.first("asked").alias("asked"))
    joined = texts.groupBy("t_id", "t_print").agg(F.min("text").alias("text")).join(
        one, (F.col("t_print") == F.col("print")) & F.col("t_id").eqNullSafe(F.col("doc_id"))
    )
    # Runs of letters and digits with what lies before each, whose lengths add up to places.
    runs = F.regexp_extract_all("text", F.lit(RUN), F.lit(0))
    gaps = F.slice(F.split("text", RUN, -1), F.lit(1), F.size(runs))
    parts = joined.select(*once, "found", "asked", F.posexplode(F.arrays_zip(runs.alias("run"), gaps.alias("gap"))))
    along = Window.partitionBy(*once).orderBy("pos")
    n = F.char_length("col.run")
    placed = parts.withColumn("end", F.sum(n + F.char_length("col.gap")).over(along).cast("int"))
    term = placed.withColumn("start", F.col("end") - n).filter(
        F.array_contains("asked", F.lower("col.run"))
        & ~F.exists("found", lambda m: (m["start"] < F.col("end")) & (F.col("start") < m["end"]))
    )
    span = F.struct(F.lit("term").alias("kind"), F.col("start"), F.col("end"))
    return term.groupBy(*once).agg(F.array_sort(F.collect_set(span)).alias("withheld"))


def protected(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    disclosed: float = DISCLOSED,
    chance: float = CHANCE,
) -> DataFrame:
    """A row per document: ``doc_id``, ``found``, the mentions, and ``withheld``, the
    terms that reveal one, both ``array<struct<kind, start, end>>``."""
    scan = settle(scanned(docs, id_col, text_col), "mentions")
    told = settle(disclosing(scan, disclosed, chance), "disclosing-terms")
    places = _withheld(docs, scan, told, id_col, text_col).select(
        F.col("doc_id").alias("w_id"), F.col("print").alias("w_print"), "withheld"
    )
    none = F.expr("cast(array() as array<struct<kind: string, start: int, end: int>>)")
    same = (F.col("print") == F.col("w_print")) & F.col("doc_id").eqNullSafe(F.col("w_id"))
    return scan.select("doc_id", "print", "found").join(places, same, "left").select(
        "doc_id", "found", F.coalesce("withheld", none).alias("withheld")
    )


def report(spans: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the mentions, and all spans written out."""
    found = F.col("found")
    return spans.select(
        "doc_id",
        *[of_kind(found, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(found), 256).alias("base_sha256"),
        listed(F.concat("found", "withheld")).alias("spans"),
    )


def sanitised(text: Column, found: Column, withheld: Column) -> Column:
    """The text with each mention generalised to its kind and each revealing term
    removed. Where spans overlap, the later one's rest is removed as well."""
    order = F.array_sort(
        F.transform(
            F.concat(found, withheld), lambda s: F.struct(s["start"], s["end"], s["kind"])
        )
    )

    def cut(state: Column, s: Column) -> Column:
        gap = F.greatest(s["start"] - state["at"], F.lit(0))
        put = F.when(s["start"] < state["at"], "").when(s["kind"] == "term", "").otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        )
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(state["out"], F.array(F.substring(text, state["at"] + 1, gap), put)).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.aggregate(
        order,
        begin,
        cut,
        lambda s: F.concat(
            F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.char_length(text))
        ),
    )
