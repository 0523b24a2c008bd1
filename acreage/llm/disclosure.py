"""Personal data and the terms that give it away (operator 4, SQL functions only).

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Each found value is a protected entity. By
information theory, a term discloses an entity to the extent that seeing the term removes the entity's information:
PMI(entity; term) / IC(entity), with probabilities estimated from how many documents hold the two, and both at once.
The share of a term's documents that hold the entity is taken at the lower end of its confidence interval, so entities
of any number of texts count and rare terms need a rarer entity. A term whose disclosure of some entity reaches the
threshold is marked wherever it occurs in any text, to be generalised; the entities themselves are removed.

Texts are read for the base matches, for the terms of the texts that hold entities, for the number of documents of these
terms, for which texts hold a marked term, and for the places of the marked ones, which are only sought in those texts.
Texts are not shuffled unless more of them are to be looked up than may be broadcast. Distinct terms of texts
with entities are paired with groups of entities that the same texts hold; counts are summed map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.shared import cut_lineage
from acreage.llm.spans import Kind, listing, located, quoted, tagged
from acreage.session import broadcast_counted

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DIGITS = "regexp_replace(x.value, '[^0-9]', '')"
_LUHN = (
    f"aggregate(sequence(1, length({_DIGITS})), 0, (sum, i) -> sum + if(i % 2 = 1, cast(substr(reverse({_DIGITS}), i, 1) as int), "
    f"if(2 * cast(substr(reverse({_DIGITS}), i, 1) as int) > 9, 2 * cast(substr(reverse({_DIGITS}), i, 1) as int) - 9, "
    f"2 * cast(substr(reverse({_DIGITS}), i, 1) as int)))) % 10 = 0"
)

#: The contract's patterns; possessive where that cannot change a match, so that long runs need no backtracking. Runs
#: of fewer than 12 card digits would be dropped anyway and are not matched.
KINDS = [
    Kind("email", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", f"x.value rlike r'^{_OCTET}(?:\\.{_OCTET}){{3}}$'"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", None, f"length({_DIGITS}) <= 19 and {_LUHN}"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", f"length({_DIGITS}) between 9 and 15"),
]

#: Terms of a text whose places are summed up at once.
PORTION = 32
#: Standard errors to the lower end of the one-sided 95 % interval, and the share of an entity's information given away.
CONFIDENCE, THRESHOLD = 1.645, 0.8

#: A term is a run of ASCII letters and non-ASCII characters, three or more, lowered.
_TERM = r"[a-z\x{80}-\x{10FFFF}]{3,}+"
_NOT_TERM = r"[^a-z\x{80}-\x{10FFFF}]++"
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _base(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return located(rows.withColumn("text_key", F.xxhash64("text")), KINDS)


def _bodies(docs: DataFrame, text_column: str) -> DataFrame:
    """(text_key, body): lowered texts, with spaces in place of addresses, whose letters are no terms."""
    mail = quoted(KINDS[0].pattern)
    masked = F.expr(
        f"array_join(zip_with(split(text, {mail}, -1), transform(regexp_extract_all(text, {mail}, 0), x -> repeat(' ', length(x))), "
        "(gap, blank) -> concat(gap, coalesce(blank, ''))), '')"
    )
    rows = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.select(F.xxhash64("text").alias("text_key"), F.when(F.col("text").contains("@"), masked).otherwise(F.col("text")).alias("masked"))
    return rows.select("text_key", F.expr(_LOWERED.format("masked")).alias("body"))


def _distinct_terms(bodies: DataFrame) -> DataFrame:
    """(text_key, term) of each row's distinct terms."""
    words = bodies.select("text_key", F.explode(F.array_distinct(F.split("body", _NOT_TERM))).alias("term"))
    return words.where(F.length("term") >= 3)


def _occurrences(bodies: DataFrame) -> DataFrame:
    """(text_key, term, start, end) of every occurrence of every term.

    Running sums grow an array, so they are taken over portions of a text's terms, and over the portions.
    """
    rows = bodies.withColumn("terms", F.expr(f"regexp_extract_all(body, {quoted(_TERM)}, 0)")).where(F.size("terms") > 0)
    rows = rows.withColumn("gaps", F.expr(f"transform(split(body, {quoted(_TERM)}, -1), g -> length(g))")).drop("body")
    rows = rows.withColumn("portions", F.expr(f"""transform(sequence(0, (size(terms) - 1) div {PORTION}), p -> struct(
        slice(terms, p * {PORTION} + 1, {PORTION}) as terms, slice(gaps, p * {PORTION} + 1, least({PORTION}, size(terms) - p * {PORTION})) as gaps))"""))
    rows = rows.select("text_key", "portions")
    rows = rows.withColumn("lengths", F.expr(
        "transform(portions, p -> aggregate(p.gaps, 0, (s, g) -> s + g) + aggregate(p.terms, 0, (s, t) -> s + length(t)))"
    ))
    rows = rows.withColumn("bases", F.expr("aggregate(lengths, struct(0 as pos, cast(array() as array<int>) as out), (s, n) -> struct("
                                           "s.pos + n as pos, concat(s.out, array(s.pos)) as out), s -> s.out)"))
    rows = rows.select("text_key", F.explode(F.arrays_zip("portions", "bases")).alias("p"))
    rows = rows.select("text_key", F.col("p.portions.terms").alias("terms"), F.col("p.portions.gaps").alias("gaps"), F.col("p.bases").alias("base"))
    placed = F.expr("""aggregate(sequence(0, size(terms) - 1), struct(base as pos, cast(array() as array<struct<term:string,start:int,end:int>>) as out),
        (s, i) -> struct(s.pos + gaps[i] + length(terms[i]) as pos, concat(s.out, array(struct(
            terms[i] as term, s.pos + gaps[i] as start, s.pos + gaps[i] + length(terms[i]) as end))) as out), s -> s.out)""")
    return rows.select("text_key", F.explode(placed).alias("t")).select("text_key", "t.term", "t.start", "t.end")


def _lower_end(hits: Column, of: Column, errors: float) -> Column:
    """Lower end of Wilson's interval of the share ``hits`` / ``of``."""
    square = errors * errors
    middle = hits + square / 2
    return (middle - errors * F.sqrt(hits * (of - hits) / of + square / 4)) / (of + square)


def disclosing(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", confidence: float = CONFIDENCE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, at_email, at_ip, at_card, at_phone, at_term) of every row.

    A null text is empty and has no spans; rows with null or equal ids and repeated rows all come back; rows of one text
    have the same spans. Empty tables give no rows. Very long texts are searched whole. Only the named columns are read.
    Runs jobs while it builds its result: base spans and counts are written to the shared folder.
    """
    base = cut_lineage(_base(docs, id_column, text_column).drop("text"))
    kinds = [k.name for k in KINDS]
    listed = F.concat(*(tagged(F.col(f"at_{k}"), F.lit(k), "kind", "start", "value") for k in kinds))
    some = sum((F.size(f"at_{k}") for k in kinds), F.lit(0)) > 0
    entities = base.where(some).select("text_key", F.explode(F.array_distinct(F.transform(
        listed, lambda x: F.struct(x["kind"].alias("kind"), F.lower(x["value"]).alias("value"))
    ))).alias("e")).select("text_key", "e.kind", "e.value")
    # A text's copies are counted, not repeated: terms are paired once for each text.
    texts = cut_lineage(entities.groupBy("text_key", "kind", "value").agg(F.count("*").alias("copies")))
    # Entities of the same texts give the same counts, so one of them stands for all.
    alike = F.struct(F.count("*").alias("texts"), F.sum(F.col("text_key").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("text_key")).alias("bits"))
    holders = texts.groupBy("kind", "value").agg(F.sum("copies").alias("of_entity"), alike.alias("alike"))
    holders = holders.groupBy("alike").agg(F.min(F.struct("kind", "value")).alias("e"), F.first("of_entity").alias("of_entity"))
    holders = cut_lineage(holders.select("e.kind", "e.value", "of_entity"))
    texts = cut_lineage(texts.join(holders, ["kind", "value"]))
    total = base.count()

    bodies = _bodies(docs, text_column)
    keys = cut_lineage(texts.select("text_key").distinct())
    held = bodies.join(broadcast_counted(keys), "text_key", "left_semi")
    near = cut_lineage(_distinct_terms(held).distinct())
    candidates = cut_lineage(near.select("term").distinct())
    found = _distinct_terms(bodies).join(broadcast_counted(candidates), "term")
    counts = cut_lineage(found.groupBy("term").agg(F.count("*").alias("of_term")))

    n = F.lit(float(max(total, 1)))
    information = F.log(n / F.col("of_entity"))

    def share(both: Column) -> Column:
        mutual = F.log(n * _lower_end(both, F.col("of_term"), confidence) / F.col("of_entity"))
        # An entity that all documents hold carries no information that a term could disclose.
        return F.when(information > 0, mutual / information).otherwise(0.0)

    # A pair whose term would not reach the threshold even if all the entity's documents held it is not counted.
    pairs = near.join(counts, "term").join(texts, "text_key").where(share(F.least("of_entity", "of_term")) >= threshold)
    pairs = pairs.groupBy("kind", "value", "term", "of_entity", "of_term").agg(F.sum("copies").alias("both"))
    marked = cut_lineage(pairs.where(share(F.col("both")) >= threshold).select("term").distinct())
    marked = broadcast_counted(marked)
    holding = broadcast_counted(cut_lineage(_distinct_terms(bodies).join(marked, "term", "left_semi").select("text_key").distinct()))
    places = _occurrences(bodies.join(holding, "text_key", "left_semi"))
    spans = places.join(marked, "term").groupBy("text_key").agg(
        F.collect_set(F.struct("start", "end", F.col("term").alias("value"))).alias("at_term")
    )
    return base.join(spans, "text_key", "left").withColumn(
        "at_term", F.coalesce(F.array_sort("at_term"), F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)"))
    )


def disclosure_digest(found: DataFrame) -> DataFrame:
    """The contract's columns; term spans are listed after the base kinds."""
    base: list[tuple[str, Column]] = [(k.name, F.col(f"at_{k.name}")) for k in KINDS]
    return found.select(
        "doc_id", *(F.size(f"at_{k.name}").cast("bigint").alias(f"n_{k.name}") for k in KINDS),
        F.sha2(listing(base), 256).alias("base_sha256"), listing([*base, ("term", F.col("at_term"))]).alias("spans"),
        F.size("at_term").cast("bigint").alias("n_term"),
    )


def sanitised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """(doc_id, text): every span replaced by its kind in brackets; overlapping spans by the first one's kind.

    Texts are joined to their spans by a hash of the whole text, so null and repeated ids do no harm.
    """
    found = disclosing(docs, id_column, text_column, **options)
    kinds = [*(k.name for k in KINDS), "term"]
    spans = F.array_sort(F.concat(*(tagged(F.col(f"at_{k}"), F.lit(k), "kind", "start", "end") for k in kinds)))
    spans = found.select("text_key", spans.alias("spans")).where(F.size("spans") > 0).dropDuplicates(["text_key"])
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text")).join(spans, "text_key", "left")
    rebuilt = F.expr(
        "aggregate(spans, struct(0 as pos, '' as done), (s, x) -> if(x.start < s.pos, s, struct(x.end as pos, "
        "concat(s.done, substr(text, s.pos + 1, x.start - s.pos), '[', upper(x.kind), ']') as done)), "
        "s -> concat(s.done, substr(text, s.pos + 1)))"
    )
    return rows.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(rebuilt).alias("text"))
