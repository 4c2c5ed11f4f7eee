"""Personal data and the terms that reveal it; DataFrame functions only.

Patterns find e-mail addresses, IP addresses, card numbers and telephone numbers. Each distinct
value is a protected entity. A term is a word outside personal data; it meets an entity in every text
that holds both, wherever they stand. Its disclosure is the share of the uncertainty about the entity that
knowing the term removes, from counts of distinct texts over the whole corpus:
``(p(entity | term) - p(entity)) / (1 - p(entity))``, 1 for a term seen with that entity alone, 0 for
one that is independent of it. What is compared with the limits is a smoothed estimate, with
``n_both / (n_term + 0.5)`` for ``p(entity | term)``: one meeting gives 0.67, five of five 0.91. Neither
depends on the size of the corpus. Copies of one text are one text, so they prove nothing.

Terms from ``GENERALISE`` on are generalised, from ``REMOVE`` on they go, wherever they stand, in texts without
personal data too: a name reveals its owner's address in any text. A term is generalised to the longest of its beginnings that
cannot reveal: a beginning of a word so common that the entity's texts are less than the limit's share of that
word's (``ottoline`` to ``ott*``). Where there is none it goes.

Entities that stand in the same texts reveal alike and are one class, so a text of thousands of addresses
met nowhere else has one class. A pair that could not reach the limit even if it met whenever possible
is left out by the counts of its entity and its term before it is formed.

Defined results: a null text is empty; repeated rows count each and are treated alike;
an entity in every document has no information to disclose, so no term reveals it; an empty table
gives an empty result; a text of n characters with many entities costs about n times the root of n,
whatever its entities are; other columns, whatever their names, stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import fresh, hot_join, let, small, store

#: The four patterns. Written so that each start is tried once and nothing recurses: what a run of
#: its characters cannot match from its beginning (or from the end of the last match) it cannot match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "term")

#: Characters of a block, at least: a piece of a long text is cut out of the blocks it lies in.
BLOCK = 1024
#: A term: three or more letters or digits of any script, the first a letter.
TERM = r"[\p{L}][\p{L}\p{N}]{2,}+"
#: Texts with the term but not the entity that are taken for granted beside those seen.
UNSEEN = 0.5
GENERALISE = 0.6
REMOVE = 0.9
#: Letters by which beginnings are lengthened at a time, as long as one of them cannot reveal.
BEGINNING = 16


def find_spans(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, value>>`` of all matches, in code points, end exclusive.

    The gaps between the matches are what a split leaves. The running sums over gaps and matches
    are taken in blocks of about the root of their number, so many matches stay cheap.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def total(values):
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def placed(found, gaps):
        width = F.ceil(F.sqrt(F.size(found))).cast("int")
        steps = F.transform(found, lambda v, i: F.length(gaps[i]) + F.length(v))

        def ends(s):
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / width).cast("int")), lambda b: total(F.slice(s, b * width + 1, width)))
            before = let(blocks, lambda bl: F.transform(bl, lambda x, b: total(F.slice(bl, F.lit(1), b))))

            def of(be):
                return F.transform(
                    s,
                    lambda x, i: be[F.floor(i / width).cast("int")]
                    + total(F.slice(s, F.floor(i / width).cast("int") * width + 1, i % width + 1)),
                )

            return let(before, of)

        return let(
            let(steps, ends),
            lambda e: F.transform(
                found, lambda v, i: F.struct((e[i] - F.length(v)).alias("start"), e[i].alias("end"), v.alias("value"))
            ),
        )

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda g: placed(m, g))))


def digits(value: Column) -> Column:
    return F.translate(value, " ().+-", "")


def luhn(value: Column) -> Column:
    """Whether the digits' check sum holds: from the right, every second one doubled, less 9 if above 9."""

    def weighed(d):
        at = F.sequence(F.lit(1), F.length(d))

        def one(i):
            digit = F.substr(d, F.length(d) + 1 - i, F.lit(1)).cast("int")
            twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
            return F.when(i % 2 == 0, twice).otherwise(digit)

        return F.aggregate(F.transform(at, one), F.lit(0), lambda a, x: a + x) % 10 == 0

    return let(value, weighed)


def base_spans(text: Column) -> Column:
    """``array<struct<start, rank, end, kind, value>>`` of the four kinds, by start, then kind."""
    checks = {
        "email": (EMAIL, lambda v: F.lit(True), "@"),
        "ip": (IP, lambda v: v.rlike(f"^{PART}(?:\\.{PART}){{3}}$"), "."),
        "card": (CARD, lambda v: F.length(digits(v)).between(12, 19) & luhn(digits(v)), None),
        "phone": (PHONE, lambda v: F.length(digits(v)).between(9, 15), "+"),
    }
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")

    def kind(t, name):
        pattern, check, needs = checks[name]
        good = F.filter(find_spans(t, pattern), lambda s: check(s["value"]))
        rows = F.transform(
            good,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(BASE.index(name)).alias("rank"), s["end"].alias("end"), F.lit(name).alias("kind"), s["value"].alias("value")
            ),
        )
        return rows if needs is None else F.when(F.contains(t, F.lit(needs)), rows).otherwise(none)

    return let(F.coalesce(text, F.lit("")), lambda t: F.array_sort(F.concat(*[kind(t, name) for name in BASE])))


def _blocks(text: Column) -> Column:
    """The text in blocks of one width (the last may be shorter), with that width and its length."""
    size = F.length(text)
    width = F.greatest(F.ceil(F.sqrt(size)).cast("int"), F.lit(BLOCK))
    cut = lambda w: F.regexp_extract_all(text, F.concat(F.lit("(?s).{1,"), w.cast("string"), F.lit("}+")), F.lit(0))
    return let(width, lambda w: F.struct(w.alias("width"), size.alias("size"), cut(w).alias("blocks")))


def _between(cut: Column, begin: Column, end: Column) -> Column:
    """The characters from ``begin`` on and before ``end`` of a text in blocks."""
    first = F.floor(begin / cut["width"]).cast("int")
    last = F.floor((F.greatest(end, begin + 1) - 1) / cut["width"]).cast("int")
    held = F.array_join(F.slice(cut["blocks"], first + 1, last - first + 1), "")
    return F.substr(held, begin - first * cut["width"] + 1, F.greatest(end - begin, F.lit(0)))


def _reach(marks: Column) -> Column:
    """The furthest end of the marks before each, so that overlapping marks add nothing twice; by blocks of marks."""
    width = F.ceil(F.sqrt(F.size(marks))).cast("int")

    def of(ends):
        most = F.transform(F.sequence(F.lit(0), F.floor((F.size(ends) - 1) / width).cast("int")), lambda b: F.array_max(F.slice(ends, b * width + 1, width)))
        before = let(most, lambda x: F.transform(x, lambda _, b: F.coalesce(F.array_max(F.slice(x, F.lit(1), b)), F.lit(0))))

        def furthest(i, bl):
            return F.greatest(bl[F.floor(i / width).cast("int")], F.array_max(F.slice(ends, F.floor(i / width).cast("int") * width + 1, i % width)))

        return let(before, lambda bl: F.transform(ends, lambda _, i: furthest(i, bl)))

    return let(F.transform(marks, lambda s: s["end"]), of)


def _replaced(text: Column, marks: Column, label, covered) -> Column:
    """The text with ``label(mark)`` in place of each mark, in order of their starts.

    A mark that starts before an earlier one ends is replaced by ``covered(mark, that end)``.
    """

    def rebuilt(m, cut):
        def pieces(r):
            return F.transform(m, lambda s, i: F.when(s["start"] >= r[i], F.concat(_between(cut, r[i], s["start"]), label(s))).otherwise(covered(s, r[i])))

        end = F.array_max(F.transform(m, lambda s: s["end"]))
        return F.concat(F.array_join(let(_reach(m), pieces), ""), _between(cut, end, cut["size"]))

    return let(marks, lambda m: F.when(F.size(m) == 0, text).otherwise(let(_blocks(text), lambda cut: rebuilt(m, cut))))


def masked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of its personal data; places stay."""
    blanks = lambda n: F.repeat(F.lit(" "), F.greatest(n, F.lit(0)))
    return _replaced(text, spans, lambda s: blanks(s["end"] - s["start"]), lambda s, end: blanks(s["end"] - end))


def _terms(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _scan(docs: DataFrame) -> DataFrame:
    """Stored ``(doc_id, text_hash, spans, terms)`` of every document; terms beside personal data, for the others see ``_others``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text"), base_spans(text).alias("spans"))
    bare = F.when(F.size("spans") > 0, masked(F.col("text"), F.col("spans")))
    found = found.select("doc_id", F.xxhash64("text").alias("text_hash"), "spans", bare.alias("bare"))
    return store(found.select("doc_id", "text_hash", "spans", _terms(F.col("bare")).alias("terms")), "privacy-scan")


def _others(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """``(text_hash, text)`` of every document without personal data; read anew, since their terms would take more room than they."""
    private = store(scanned.filter("size(spans) > 0").select("text_hash").distinct(), "privacy-hashes")
    texts = docs.select(_text_hash().alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(small(private, 16), "text_hash", "left_anti")


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"]).otherwise(digits(span["value"]))
    return F.concat_ws(":", span["kind"], value)


def _counted(scanned: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored ``(text_hash, entity)``, ``(entity, n_entity, c1, c2)``, ``(text_hash, term)`` and ``(term, n_term, n_private)``.

    The first three are of texts with personal data, ``n_term`` counts all texts, ``n_private`` those with personal
    data, each text once. ``c1, c2`` name the set of texts that hold the entity.
    """
    private = scanned.filter("size(spans) > 0").select("text_hash", "spans", "terms").dropDuplicates(["text_hash"])
    private = store(private, "privacy-texts")
    held = store(private.select("text_hash", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity")), "privacy-held")
    mark = lambda k: F.bit_xor(F.xxhash64(F.lit(k), "text_hash")).alias(f"c{k}")
    entities = store(held.groupBy("entity").agg(F.count("*").alias("n_entity"), mark(1), mark(2)), "privacy-entities")
    standing = store(private.select("text_hash", F.explode("terms").alias("term")), "privacy-terms")
    others = others.dropDuplicates(["text_hash"]).select(F.explode(_terms(F.col("text"))).alias("term"), F.lit(0).alias("private"))
    counts = standing.select("term", F.lit(1).alias("private")).unionAll(others).groupBy("term")
    counts = counts.agg(F.count("*").alias("n_term"), F.sum("private").alias("n_private"))
    return held, entities, standing, store(counts, "privacy-vocabulary")


def _pairs(scanned: DataFrame, counted: tuple[DataFrame, DataFrame, DataFrame, DataFrame], least: float) -> DataFrame:
    """``(c1, c2, n_entity, term, n_term, disclosure, smoothed)`` of the pairs that meet and may reach ``least``."""
    held, entities, standing, vocabulary = counted
    most = entities.agg(F.max("n_entity")).first()[0] or 0
    possible = vocabulary.select("term", "n_term").filter((F.col("n_term") + UNSEEN) * least <= F.least(F.lit(most), F.col("n_term")))
    there = store(hot_join(standing, possible, ["term"]), "privacy-there")
    present = store(hot_join(held, entities, ["entity"]).select("text_hash", "c1", "c2", "n_entity").distinct(), "privacy-present")
    may = (F.col("n_term") + UNSEEN) * least <= F.least("n_entity", "n_term")
    met = there.join(present, "text_hash").filter(may).groupBy("c1", "c2", "n_entity", "term", "n_term").agg(F.count("*").alias("n_both"))
    alone = F.col("n_entity") / float(max(scanned.select("text_hash").distinct().count(), 1))

    def share(unseen: float) -> Column:
        return F.when(alone < 1, (F.col("n_both") / (F.col("n_term") + unseen) - alone) / (1 - alone))

    return met.select("c1", "c2", "n_entity", "term", "n_term", share(0).alias("disclosure"), share(UNSEEN).alias("smoothed"))


def disclosures(docs: DataFrame, scanned: DataFrame, least: float = 0) -> DataFrame:
    """``(entity, term, disclosure, smoothed)`` of every pair that meets, by distinct texts; ``entity`` is ``kind:value``.

    With ``least`` only pairs whose smoothed disclosure may reach it.
    """
    counted = _counted(scanned, _others(docs, scanned))
    return _pairs(scanned, counted, least).join(counted[1], ["c1", "c2", "n_entity"]).select("entity", "term", "disclosure", "smoothed")


def _broader(strong: DataFrame, vocabulary: DataFrame, generalise: float) -> DataFrame:
    """``(term, broader)`` of the terms with a beginning that cannot reveal: the longest of them.

    A longer beginning is never commoner. So terms go on to longer ones only from a whole step of safe ones,
    and only words that share those are looked at.
    """

    def beginnings(frame: DataFrame, longest: Column, at: int, *columns: str) -> DataFrame:
        size = F.explode(F.sequence(F.lit(at + 1), F.least(longest, F.lit(at + BEGINNING)))).alias("size")
        return frame.filter(longest > at).select("*", size).select(*columns, "size", F.substring("term", F.lit(1), F.col("size")).alias("beginning"))

    found, left, words, at = [], strong, vocabulary, 0
    while True:
        own = store(beginnings(left, F.length("term") - 1, at, "term", "n_entity"), "privacy-beginnings")
        asked = small(store(own.select("beginning").distinct(), "privacy-asked"), 64 + 4 * at)
        common = beginnings(words, F.length("term"), at, "n_term").join(asked, "beginning").groupBy("beginning").agg(F.max("n_term").alias("n_common"))
        safe = own.join(common, "beginning").filter((F.col("n_common") + UNSEEN) * generalise > F.col("n_entity"))
        safe = store(safe.groupBy("term", "n_entity").agg(F.max("size").alias("size"), F.max_by("beginning", "size").alias("broader")), "privacy-broader")
        found.append(safe.select("term", "size", "broader"))
        at += BEGINNING
        left = store(safe.filter((F.col("size") == at) & (F.length("term") - 1 > at)).select("term", "n_entity", "broader"), "privacy-longer")
        if left.isEmpty():
            break
        shared = small(store(left.select("broader").distinct(), "privacy-shared"), 32 + 4 * at)
        words = store(vocabulary.withColumn("broader", F.substring("term", 1, at)).join(shared, "broader", "left_semi").select("term", "n_term"), "privacy-sharing")
    longest = found[0]
    for step in found[1:]:
        longest = longest.unionAll(step)
    return longest.groupBy("term").agg(F.max_by("broader", "size").alias("broader"))


def _hidden(scanned: DataFrame, counted: tuple[DataFrame, DataFrame, DataFrame, DataFrame], generalise: float, remove: float) -> DataFrame:
    """Stored ``(term, action, label, elsewhere)`` of each revealing term: what is done to it and what takes its place.

    ``elsewhere`` tells whether it also stands in texts without personal data.
    """
    strong = _pairs(scanned, counted, generalise).filter(F.col("smoothed") >= generalise)
    strong = store(strong.groupBy("term").agg(F.max("smoothed").alias("smoothed"), F.max("n_entity").alias("n_entity")), "privacy-strong")

    broad = _broader(strong, counted[3].select("term", "n_term"), generalise)
    elsewhere = counted[3].filter("n_term > n_private").join(small(strong.select("term"), 64), "term", "left_semi").select("term", F.lit(True).alias("elsewhere"))
    goes = (F.col("smoothed") >= remove) | F.col("broader").isNull()
    return store(
        strong.join(broad, "term", "left").join(elsewhere, "term", "left").select(
            "term",
            F.when(goes, "removed").otherwise("generalised").alias("action"),
            F.when(goes, "").otherwise(F.concat("broader", F.lit("*"))).alias("label"),
            F.coalesce("elsewhere", F.lit(False)).alias("elsewhere"),
        ),
        "privacy-hidden",
    )


def reveal(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``(doc_id, text_hash, spans, terms)`` of every document.

    ``spans`` holds the personal data, ``terms`` the places of revealing terms with their ``action`` and
    the ``label`` that takes their place.
    """
    scanned = _scan(docs)
    others = _others(docs, scanned)
    counted = _counted(scanned, others)
    hidden = _hidden(scanned, counted, generalise, remove)
    known = small(hidden.select("term", "action", "label"), 192)
    wanted = counted[2].join(known, "term", "left_semi").select("text_hash")
    elsewhere = store(hidden.filter("elsewhere").select("term"), "privacy-elsewhere")
    if not elsewhere.isEmpty():
        places = others.select("text_hash", F.explode(_terms(F.col("text"))).alias("term"))
        wanted = wanted.unionAll(places.join(small(elsewhere, 64), "term", "left_semi").select("text_hash"))
    wanted = store(wanted.distinct(), "privacy-wanted")
    texts = docs.select("text", _text_hash().alias("text_hash")).join(small(wanted, 16), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    bare = texts.select("text_hash", "text", base_spans(F.col("text")).alias("spans")).select("text_hash", masked(F.col("text"), F.col("spans")).alias("text"))
    places = bare.select("text_hash", F.explode(find_spans(F.col("text"), TERM)).alias("t")).select("text_hash", "t.start", "t.end", F.lower("t.value").alias("term"))
    places = places.join(known, "term").groupBy("text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end", "action", "label"))).alias("hidden"))
    places = store(places, "privacy-places")
    base = scanned.select("doc_id", "text_hash", "spans")
    none = F.array().cast("array<struct<start:int,end:int,action:string,label:string>>")
    some = hot_join(base.join(small(wanted, 16), "text_hash", "left_semi"), places, ["text_hash"])
    rest = base.join(small(wanted, 16), "text_hash", "left_anti").withColumn("terms", none)
    return some.select("doc_id", "text_hash", "spans", F.col("hidden").alias("terms")).unionAll(rest.select("doc_id", "text_hash", "spans", "terms"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a checksum of their spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def row(s, rank, kind):
        return F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), kind.alias("kind"))

    base = F.transform("spans", lambda s: row(s, s["rank"], s["kind"]))
    terms = F.transform("terms", lambda s: row(s, F.lit(len(BASE)), F.lit("term")))
    return found.select(
        "doc_id",
        *map(count, BASE),
        F.sha2(listed(F.col("spans")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat(base, terms))).alias("spans"),
        F.size("terms").cast("bigint").alias("n_term"),
    )


def sanitised(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """The documents with their personal data replaced by ``[kind]`` and revealing terms hidden.

    Overlapping spans become one, named after the first. All other columns stay.
    """
    id_, hash_, spans, terms = fresh(docs, "privacy_id", "privacy_text", "privacy_spans", "privacy_terms")
    found = reveal(docs, generalise, remove).filter("size(spans) > 0 or size(terms) > 0").distinct().toDF(id_, hash_, spans, terms)
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(hash_))

    def mark(s, label):
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), label.alias("label"))

    base = F.transform(spans, lambda s: mark(s, F.concat(F.lit("["), s["kind"], F.lit("]"))))
    hidden = F.transform(terms, lambda s: mark(s, s["label"]))
    marks = F.array_sort(F.concat(base, hidden))

    replaced = _replaced(F.col("text"), marks, lambda s: s["label"], lambda s, end: F.lit(""))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(replaced)
    return docs.join(found, same, "left").withColumn("text", text).select(*docs.columns)
