"""Personal data: what patterns find, and the words that give it away.

Information-theoretic sanitisation. The protected entities are the values that
the patterns find (an e-mail address, an ip, a card or a phone number). How much
a term reveals of an entity is estimated from the corpus: their pointwise mutual
information, as a share of the entity's own information content,

    ln(N c(e,t) / (c(e) c(t))) / ln(N / c(e)),

where ``c`` counts documents: with the entity, with the term, and with the term
in the entity's context. A term that reveals ``threshold`` of it or more is
generalised to its first letters if these reveal less, and else removed.

All of it is columns and SQL functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import BROADCAST_IDS, small, table

#: Code points on either side of an entity that are its context.
CONTEXT = 80
#: Share of an entity's information from which a term is sanitised.
THRESHOLD = 0.6
#: Documents in which a term must be in an entity's context: one is no estimate.
SUPPORT = 2
#: Code points that are left of a generalised term; terms are longer.
STEM = 3
#: Elements of one stretch of a running sum.
BLOCK = 512

KINDS = ("email", "ip", "card", "phone")
ACTIONS = ("generalised", "removed")
# The same matches as the plain patterns, but in linear time: a match starts
# where a run of its characters starts (or where the match before ended), and
# what it takes it doesn't give back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: What words are made of, for terms: letters, and what joins them to an address or a number.
_JOINED = r"\p{L}\p{N}@._%+-"
_ENDS = "._%+-"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPAN = "array<struct<start:int,end:int,kind:int,value:string,before:string,after:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    """Whether a match is what it looks like."""
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _running(lengths: Column) -> Column:
    """Sums of the first 1, 2, ... elements, by stretches of ``BLOCK``: arrays
    grow by copies, so one array for all would cost the square."""
    sums = lambda of: F.aggregate(
        of, F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("a")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.array_append(acc["a"], acc["s"] + x).alias("a")))["a"]
    stretches = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                            lambda b: sums(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    before = lambda parts: F.slice(F.concat(F.array(F.lit(0)), sums(F.transform(parts, lambda p: F.element_at(p, -1)))), F.lit(1), F.size(parts))
    joined = F.transform(F.array(stretches), lambda parts: F.zip_with(parts, before(parts), lambda p, o: F.transform(p, lambda x: x + o)))
    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(F.flatten(F.element_at(joined, 1)))


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: all that the patterns find in the whole text, as
    ``(start, end, kind, value, before, after)`` by start, then kind; code
    points, end exclusive, ``kind`` counting in ``KINDS``, and what lies
    before and after up to ``CONTEXT`` or the next match of its kind. Null
    texts have none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast("array<string>")
    own = docs.columns
    found = docs.select("*", *(F.when(needs.get(k, F.lit(True)), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(f"_m_{k}") for k, p in PATTERNS.items()))
    found = found.select("*", *(F.when(F.size(f"_m_{k}") > 0, F.split(text, p, -1)).otherwise(none).alias(f"_g_{k}") for k, p in PATTERNS.items()))
    taken = lambda k: F.transform(f"_m_{k}", lambda m, i: F.length(m) + F.length(F.get(f"_g_{k}", i))).alias(f"_l_{k}")
    found = found.select("*", *map(taken, KINDS))
    found = found.select("*", *(_running(F.col(f"_l_{k}")).alias(f"_e_{k}") for k in KINDS))

    def spans(k: str) -> Column:
        all_ = F.transform(f"_m_{k}", lambda m, i: F.struct(
            (F.get(f"_e_{k}", i) - F.length(m)).alias("start"), F.get(f"_e_{k}", i).alias("end"), F.lit(KINDS.index(k)).alias("kind"), m.alias("value"),
            F.right(F.get(f"_g_{k}", i), F.lit(CONTEXT)).alias("before"), F.left(F.get(f"_g_{k}", i + 1), F.lit(CONTEXT)).alias("after")))
        return F.filter(all_, lambda s: _holds(k, s["value"]))

    return found.select(*(F.col(f"`{c}`") for c in own), F.array_sort(F.concat(*map(spans, KINDS))).cast(_SPAN).alias("spans"))


def _entity(span: Column) -> Column:
    """The value that is protected: addresses in lower case, numbers by their digits (ips as they are)."""
    lower = F.translate(span["value"], _UPPER, _LOWER)
    plain = F.when(span["kind"] >= KINDS.index("card"), _digits(lower)).otherwise(lower)
    return F.concat(span["kind"].cast("string"), F.lit(":"), plain)


def _terms(context: Column, start: Column) -> Column:
    """``(term, start, end)`` of the words of a context that starts at ``start``.
    Words that touch either end of it, that are joined to others by ``@._%+-``
    or to digits, or of ``STEM`` letters or fewer are no terms."""
    gaps = F.regexp_extract_all(context, F.lit(f"[^{_JOINED}]+"), F.lit(0))
    words = F.split(context, f"[^{_JOINED}]+", -1)
    length = lambda of, n: F.aggregate(F.slice(of, F.lit(1), n), F.lit(0), lambda s, x: s + F.length(x))
    inner = F.when(F.size(words) > 2, F.sequence(F.lit(1), F.size(words) - 2)).otherwise(F.array().cast("array<int>"))
    found = F.transform(inner, lambda i: F.struct(
        F.translate(F.regexp_extract(F.get(words, i), rf"^(\p{{L}}{{{STEM + 1},}}+)[{_ENDS}]*$", 1), _UPPER, _LOWER).alias("term"),
        (start + length(words, i) + length(gaps, i)).alias("start")))
    return F.transform(F.filter(found, lambda t: t["term"] != ""), lambda t: F.struct(
        t["term"].alias("term"), t["start"].alias("start"), (t["start"] + F.length(t["term"])).alias("end")))


def _counted(documents: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(token, documents)``: rows of ``documents`` with a candidate term among
    its words, or with a word that starts with a candidate's first letters."""
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    words = F.filter(F.transform(F.split(lower, f"[^{_JOINED}]+", -1), lambda w: F.rtrim(w, F.lit(_ENDS))), lambda w: F.length(w) > STEM)
    words = documents.select(F.array_distinct(words).alias("w"))
    tokens = words.select(F.explode(F.concat("w", F.array_distinct(F.transform("w", lambda w: F.left(w, F.lit(STEM)))))).alias("token"))
    n = F.count(F.lit(1)).alias("documents")
    if candidates.count() <= BROADCAST_IDS:
        return tokens.join(F.broadcast(candidates), "token", "left_semi").groupBy("token").agg(n)
    return tokens.groupBy("token").agg(n).join(candidates, "token", "left_semi")


def revealing(spark: SparkSession, documents: DataFrame, mentions: DataFrame, threshold: float = THRESHOLD,
              support: int = SUPPORT) -> DataFrame:
    """``(entity, term, disclosure, action)``: the terms to sanitise around
    each entity. ``mentions``: a row for each document with entities, with
    ``terms`` as ``(entity, term, start, end)`` and ``entities``."""
    stems = F.transform("terms", lambda t: F.struct(t["entity"].alias("entity"), F.left(t["term"], F.lit(STEM)).alias("token")))
    terms = F.transform("terms", lambda t: F.struct(t["entity"].alias("entity"), t["term"].alias("token")))
    pairs = mentions.select(F.explode(F.array_distinct(F.concat(terms, stems))).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("both"))
    pairs = table(spark, pairs.filter(F.col("both") >= support).select("p.entity", "p.token", "both"), "pii-pairs")
    of_entity = mentions.select(F.explode(F.array_distinct("entities")).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    n = documents.count()
    counts = table(spark, _counted(documents, table(spark, pairs.select("token").distinct(), "pii-tokens")), "pii-counts")
    own = F.log(F.lit(float(n)) / F.col("with_entity"))
    mutual = F.log(F.lit(float(n)) * F.col("both") / (F.col("with_entity").cast("double") * F.col("documents")))
    scored = (pairs.join(small(of_entity), "entity").join(small(counts), "token")
              .select("entity", "token", F.when(own > 0, mutual / own).otherwise(0.0).alias("disclosure")))
    scored = table(spark, scored.filter(F.col("disclosure") >= threshold), "pii-scored")
    stem = scored.filter(F.length("token") == STEM).select("entity", F.col("token").alias("stem"), F.lit(True).alias("too_much"))
    strong = scored.filter(F.length("token") > STEM).withColumn("stem", F.left("token", F.lit(STEM)))
    return strong.join(stem, ["entity", "stem"], "left").select(
        "entity", F.col("token").alias("term"), "disclosure", F.when(F.col("too_much"), F.lit(ACTIONS[1])).otherwise(F.lit(ACTIONS[0])).alias("action"))


def find_personal_data(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)`` for each row of ``docs``: ``spans`` are ``(start, end,
    kind, label, value)`` by start, then kind; what the patterns find, then the
    words of its context that give it away, as ``generalised`` (``value`` is
    what is left) or ``removed``. A word that gives away several entities is
    removed if one of them asks for it.

    Null and empty texts have no spans. Repeated rows are repeated documents,
    in the counts and in the result; null ids stay null. Texts of any length
    are read whole, other columns are ignored. Words near no entity, and
    entities near which no word is found in ``support`` documents, add nothing.
    """
    documents = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    around = lambda s: F.transform(F.concat(
        _terms(s["before"], s["start"] - F.length(s["before"])), _terms(s["after"], s["end"])),
        lambda t: F.struct(_entity(s).alias("entity"), t["term"].alias("term"), t["start"].alias("start"), t["end"].alias("end")))
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    found = base_spans(documents).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", plain.alias("base"),
        F.transform("spans", _entity).alias("entities"), F.flatten(F.transform("spans", around)).alias("terms"))
    found = table(spark, found, "pii-spans")
    mentions = found.filter(F.size("base") > 0)
    strong = revealing(spark, documents, mentions, threshold, support)
    hits = mentions.select("row", F.explode("terms").alias("t")).select("row", "t.*")
    hits = hits.join(small(table(spark, strong.select("entity", "term", "action"), "pii-revealing")), ["entity", "term"])
    marks = hits.groupBy("row", "start", "end", "term").agg(F.max("action").alias("action"))
    removed = F.col("action") == ACTIONS[1]
    mark = F.struct("start", "end", F.when(removed, len(KINDS) + 1).otherwise(len(KINDS)).alias("kind"),
                    F.when(removed, F.lit("")).otherwise(F.concat(F.left("term", F.lit(STEM)), F.lit("*"))).alias("value"))
    added = table(spark, marks.groupBy("row").agg(F.collect_list(mark).alias("added")), "pii-marks")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>"))))
    label = lambda k: F.get(F.array(*map(F.lit, (*KINDS, *ACTIONS))), k)
    return found.join(small(added), "row", "left").select("doc_id", F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), label(s["kind"]).alias("label"), s["value"].alias("value"))).alias("spans"))


def as_text(spans: Column) -> Column:
    """``label:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the patterns' spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    n = lambda k: F.size(F.filter("spans", lambda s: s["label"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(n, KINDS),
                        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each entity as ``[EMAIL]`` and so on, generalised terms as
    their first letters and removed ones gone; of spans that overlap, the first
    one counts. One pass over the text for each span."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    shown = lambda s: F.when(s["kind"] < len(KINDS), F.concat(F.lit("["), F.upper(s["label"]), F.lit("]"))).otherwise(s["value"])
    step = lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
        s["end"].alias("at"), F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), shown(s))).alias("parts"))).otherwise(acc)
    return F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
