"""Personal data: fixed patterns, then information-theoretic sanitisation of revealing terms.

The patterns find the protected entities. A term of an entity's documents discloses it when the
pointwise mutual information of the two, estimated over the corpus, comes close to the
entity's own information content (Sanchez and Batet's C-sanitisation):

    PMI(e; t) = log2(N n(e,t) / (n(e) n(t)))     IC(e) = log2(N / n(e))
    disclosure(e; t) = PMI / IC  <= 1, and 1 where t occurs with e only

n counts documents; n(e,t) documents that hold a mention of e and t, wherever they stand.
Every entity and every term is judged, also one met once. A revealing term is generalised to the
narrowest of its classes (its first letters, ``LEVELS``) that tells little: one seen in ``min_support``
different texts of the corpus at least (copies of one text prove nothing) and itself under the threshold. A term
without such a class, or too short for it, is removed. Either is done at each place of the term in every document
of the entity. Class counts are sums over the class's terms.

Entities of the very same documents (known by the number and the sums of their documents' hashes)
disclose alike and are one profile: a log of 10,000 addresses met nowhere else is one. As
disclosure > alpha needs n(t) < n(e) (N / n(e))^(1 - alpha), frequent words go before any pair is
formed, so pairs are of a profile and the rare words of its documents. Words are counted by
partial aggregates in each task, no text is shuffled; different texts of a class are counted by a
64-bit set of their hashes, which may count too few (the term is then removed, not generalised), never too many.

Defined cases: null text is empty; an empty text has no span and an empty ``spans``; an
entity found in every document has no information and discloses nothing; repeated rows are
separate documents, their common text is one text; a null id is kept; other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptally.llm import base as B

# The base patterns in possessive form. Look-behinds start a run once and
# \G lets a match start inside a run where the previous match ended.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?=[0-9](?:[\x20-]?[0-9]){11})[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

MARK = "\ue000"
MARKED_TERM = rf"[\p{{L}}\p{{N}}{MARK}]+"
NOT_TERM = r"[^\p{L}\p{N}]+"
LEVELS = (3, 1)


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    """True if the digits of ``v`` pass the Luhn sum."""
    twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    at = F.transform(F.split(F.reverse(digits(v)), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(twice(c.cast("int"))))
    return F.aggregate(at, F.lit(0), lambda s, x: s + x) % 10 == 0


KINDS = [
    ("email", EMAIL, lambda v: F.lit(True)),
    ("ip", IP, lambda v: F.rlike(v, F.lit(rf"^{PART}(?:\.{PART}){{3}}$"))),
    ("card", CARD, lambda v: F.when(F.length(digits(v)).between(12, 19), luhn(v)).otherwise(False)),
    ("phone", PHONE, lambda v: F.length(digits(v)).between(9, 15)),
]
ADDED = ["generalise", "remove"]


def entity(kind: Column, value: Column) -> Column:
    """One spelling per entity: lower case, and digits only for cards and phones."""
    return F.when(kind.isin("card", "phone"), digits(value)).otherwise(F.lower(value))


def _terms(text: Column, spans: Column) -> Column:
    """array<struct<term, start, end>>: the terms of a text that no span touches.

    Spans are overwritten by as many marks, which join the letters beside them to words with a mark."""
    marked = B.replace_spans(F.translate(text, MARK, " "), spans, lambda s, n: F.repeat(F.lit(MARK), n.cast("int")))

    def words(t):
        found = B.match_spans(t, F.regexp_extract_all(t, F.lit(MARKED_TERM), F.lit(0)), MARKED_TERM)
        return F.transform(F.filter(found, lambda w: ~F.contains(w["value"], F.lit(MARK))), lambda w: F.struct(
            F.lower(w["value"]).alias("term"), w["start"].alias("start"), w["end"].alias("end")))
    none = F.array().cast("array<struct<term:string,start:bigint,end:bigint>>")
    return F.when(F.size(spans) > 0, B.let(marked, words)).otherwise(none)


KEY = ["id_hash", "text_hash"]


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, its key, base (spans), entities and terms (with their places; none in
    a document without entities). Written once; all later uses read it back."""
    d = docs.select(F.col(id_col).alias("id"), B.text_of(text_col).alias("text"))
    d = B.base_spans(d, "text", KINDS, "base")
    entities = F.array_distinct(F.transform(F.col("base"), lambda s: F.struct(
        s["kind"].alias("kind"), entity(s["kind"], s["value"]).alias("entity"))))
    return B.materialise(d.select("id", F.xxhash64("id").alias("id_hash"), F.xxhash64("text").alias("text_hash"), "base",
                                  entities.alias("entities"), _terms(F.col("text"), F.col("base")).alias("terms")), "pii")


def vocabulary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """term, n_t (documents), seen (the 64-bit set of their texts' hashes). Stored."""
    text = B.text_of(text_col)
    words = docs.select(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(text), F.lit(64)).cast("int")).alias("bit"),
                        F.array_distinct(F.transform(F.split(text, NOT_TERM), F.lower)).alias("words"))
    return B.materialise(words.select("bit", F.explode("words").alias("term")).groupBy("term").agg(
        F.count("*").alias("n_t"), F.bit_or("bit").alias("seen")), "pii-vocabulary")


def _profiles(found: DataFrame, n_docs: int) -> tuple[DataFrame, DataFrame]:
    """(kind, entity, profile, n_e), stored, and per document its profiles. An entity of every document
    tells nothing and is left out."""
    mention = found.where(F.size("entities") > 0).select(*KEY, F.explode("entities").alias("e")).select(*KEY, "e.*")
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *KEY).cast("decimal(20,0)")).cast("string")
    ents = mention.groupBy("kind", "entity").agg(F.count("*").alias("n_e"), total(1).alias("a"), total(2).alias("b"))
    ents = B.materialise(ents.where(F.col("n_e") < n_docs).select(
        "kind", "entity", F.unhex(F.md5(F.concat_ws(" ", F.col("n_e").cast("string"), "a", "b"))).alias("profile"), "n_e"),
        "pii-entities")
    own = mention.join(ents, ["kind", "entity"]).groupBy(*KEY).agg(F.collect_set(F.struct("profile", "n_e")).alias("profiles"))
    return ents, own


def _share(n_docs: int, both: Column, own: Column) -> Column:
    """Disclosure of an entity of n_e documents by what is in ``own`` documents, ``both`` of them the entity's."""
    n = F.lit(float(n_docs))
    return F.log2(n * F.least(both, own) / (F.col("n_e") * own)) / F.log2(n / F.col("n_e"))


def _judged(docs: DataFrame, found: DataFrame, text_col: str, alpha: float, min_support: int):
    """(entities, judged, hits): the entities with their profiles; profile, term, disclosure, action, general;
    and per document and revealing term what becomes of it."""
    n_docs = max(found.count(), 1)
    ents, own = _profiles(found, n_docs)
    vocab = vocabulary(docs, text_col)
    most = ents.agg(F.max("n_e")).first()[0] or 1
    bound = lambda n_e: n_e * F.pow(F.lit(float(n_docs)) / n_e, F.lit(1 - alpha))
    names = F.array_distinct(F.transform(F.col("terms"), lambda w: w["term"])).alias("names")
    named = found.where(F.size("terms") > 0).select(*KEY, names)
    rare = named.select(*KEY, F.explode("names").alias("term")).join(
        vocab.where(F.col("n_t") <= bound(F.lit(float(most)))).select("term", "n_t"), "term")
    rare = rare.groupBy(*KEY).agg(F.collect_set(F.struct("term", "n_t")).alias("rare"))
    # all that is known of a document in one row: what follows explodes it where it stands
    one = B.materialise(named.join(own, KEY).join(rare, KEY, "left"), "pii-documents")
    # its rare words with its profiles, as far as the counts let them disclose
    met = one.select(*KEY, F.explode("rare").alias("w"), "profiles").select(*KEY, "w.*", F.explode("profiles").alias("p")).select(
        *KEY, "term", "n_t", "p.*").where(F.col("n_t") <= bound(F.col("n_e")))
    told = met.groupBy("profile", "n_e", "term", "n_t").agg(F.count("*").alias("n_et")).withColumn(
        "disclosure", _share(n_docs, F.col("n_et"), F.col("n_t"))).where(F.col("disclosure") > alpha)
    told = B.materialise(told, "pii-told")
    general = F.lit(None).cast("string")
    for size in reversed(LEVELS):
        head = F.substring("term", 1, size)
        classes = vocab.groupBy(head.alias("class")).agg(F.sum("n_t").alias("n_c"), F.bit_or("seen").alias("seen")).where(
            F.bit_count("seen") >= min_support)
        asked = told.where(F.length("term") > size).select("profile", "n_e", head.alias("class")).distinct()
        both = one.select(F.explode("names").alias("term"), "profiles").select(
            head.alias("class"), F.explode("profiles.profile").alias("profile")).groupBy("profile", "class").agg(
            F.count("*").alias("n_ec")).join(asked, ["profile", "class"])
        mild = both.join(classes, "class").where(_share(n_docs, F.col("n_ec"), F.col("n_c")) <= alpha).select(
            "profile", F.col("class").alias(f"c{size}"))
        told = told.withColumn("_head", head).join(
            mild.select(F.col("profile").alias("_profile"), f"c{size}"),
            (F.col("profile") == F.col("_profile")) & (F.col("_head") == F.col(f"c{size}")) & (F.length("term") > size),
            "left").drop("_profile", "_head")
        general = F.coalesce(F.col(f"c{size}"), general)
    judged = B.materialise(told.select(
        "profile", "term", "disclosure", F.when(general.isNotNull(), ADDED[0]).otherwise(ADDED[1]).alias("action"),
        F.coalesce(F.concat(general, F.lit("*")), F.lit("")).alias("general")), "pii-judged")
    rank = F.when(F.col("action") == ADDED[0], len(KINDS)).otherwise(len(KINDS) + 1)
    hits = met.select(*KEY, "profile", "term").join(judged, ["profile", "term"]).groupBy(*KEY, "term").agg(
        F.max(F.struct(rank.alias("rank"), F.col("action").alias("kind"), F.col("general").alias("value"))).alias("a"))
    return ents, judged, hits


def revealing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text", alpha: float = 0.9,
                    min_support: int = 3) -> DataFrame:
    """kind, entity, term, disclosure, action ("generalise" or "remove"), general."""
    ents, judged, _ = _judged(docs, found, text_col, alpha, min_support)
    return ents.join(judged, "profile").select("kind", "entity", "term", "disclosure", "action", "general")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.9,
           min_support: int = 3) -> DataFrame:
    """id, text_hash, base and spans: array<struct<start, rank, kind, end, value>>, by start.

    ``value`` is the found text for base kinds and the replacement for added ones."""
    found = mentions(docs, id_col, text_col)
    hits = B.materialise(_judged(docs, found, text_col, alpha, min_support)[2], "pii-hits")
    places = (found.where(F.size("terms") > 0).join(hits.select(*KEY).distinct(), KEY, "left_semi")
              .select(*KEY, F.explode("terms").alias("w")).select(*KEY, "w.*"))
    # a set: repeated rows have the same places
    added = places.join(hits, [*KEY, "term"]).groupBy(*KEY).agg(F.collect_set(F.struct(
        "start", "a.rank", "a.kind", "end", "a.value")).alias("added"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,value:string>>")
    return found.join(added, KEY, "left").select("id", "text_hash", "base", F.array_sort(
        F.concat("base", F.coalesce("added", empty))).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """docs with ``text_col`` sanitised: entities as [KIND], terms generalised or removed."""
    spans = detect(docs, id_col, text_col, **params).dropDuplicates(["id", "text_hash"])
    d = docs.withColumn("__h", F.xxhash64(B.text_of(text_col)))
    on = (d[id_col].eqNullSafe(spans["id"])) & (d["__h"] == spans["text_hash"])
    by = lambda s, n: F.when(s["rank"] < len(KINDS), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(s["value"])
    wide = d.join(spans.select("id", "text_hash", F.col("spans").alias("__spans")), on, "left")
    return wide.select(*[B.replace_spans(B.text_of(text_col), F.col("__spans"), by).alias(c) if c == text_col
                         else d[c] for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from detect()."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col("id").alias("doc_id"), *[n(k) for k, _, _ in KINDS],
                        F.sha2(B.spans_text(F.col("base")), 256).alias("base_sha256"),
                        B.spans_text(F.col("spans")).alias("spans"))
