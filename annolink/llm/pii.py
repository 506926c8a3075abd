"""Information-theoretic sanitisation of personal data, on DataFrame functions only.

Entities (e-mail addresses, IPv4 addresses, card and phone numbers) are found by
pattern and by check digit.  A word gives an entity away as far as knowing the word tells
that the entity is there: with document counts over the whole corpus,

    IC(e)     = log2(N / n(e))                      information in the entity
    PMI(e; t) = log2(N n(e, t) / (n(e) n(t)))       what the word tells of it

Their ratio is the disclosed share.  The chance of the entity given the word,
n(e, t) / n(t), is estimated with half a sighting more of each outcome, so rare words
and entities are judged too, with less confidence:
``PMI = log2(N (n(e, t) + 1/2) / (n(e) (n(t) + 1)))``.  Words of a document that holds the entity are generalised (to their initial) from ``GENERALISE`` of it on and
removed from ``REMOVE`` on.  Copies of a text count.

Entities that stand in the same texts share all counts and are judged as one; of an
entity in one text, n(e, t) is known without a join.  No word with

    n(t) + 1 > (m + 1/2) (N / m) ^ (1 - GENERALISE),  m = max n(e)

can reach the share, so the common words stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from annolink.llm.common import stored

#: kind -> (pattern, cheap test that every match passes).  Java patterns; the
#: possessive forms match what the greedy ones do, without recursion, and the
#: look-behind starts each match at its run's first character or where the last ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]++\."),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){12,}+", r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]"),
}
KINDS = tuple(PATTERNS)
GENERALISE, REMOVE, MIN_LETTERS = 0.75, 0.95, 3
#: Words of the co-occurrence statistics.
WORD = r"\p{L}{%d,}+" % MIN_LETTERS
#: Texts are cut behind a word, so that a row has about so many characters.
PIECE = r"(?s).{1,4000}\p{L}*+"
#: Most common words that are sent to the workers, to be left out there.
SENT_WORDS = 20_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.reverse(_digits(value))
    each = F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.substring(d, i, 1).cast("int") * (F.lit(2) - i % 2))
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def spans_of(text: Column, pattern: Column, possible: Column) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, value>>`` in
    code points.  Each find is the gap before a match and the match, so the
    lengths add up to the positions."""
    # \G: each find starts where the last ended, so a text is gone through once
    whole = F.concat(F.lit(r"\G(?s)(.*?)("), pattern, F.lit(")"))
    lens = F.transform(F.regexp_extract_all(text, whole, F.lit(0)), F.length)
    value = F.regexp_extract_all(text, whole, F.lit(2))
    total = lambda x: F.aggregate(x, F.lit(0), lambda s, y: s + y)

    def chunks(once: Column) -> Column:
        # chunks of about the root of the number of matches: their sums, and the sums before them
        width = F.ceil(F.sqrt(F.size(once["lens"]) + 1)).cast("int")
        sums = F.transform(F.sequence(F.lit(0), (F.size(once["lens"]) / width).cast("int")), lambda c: total(F.slice(once["lens"], c * width + 1, width)))
        return F.struct(once["lens"].alias("lens"), once["value"].alias("value"), width.alias("width"), sums.alias("sums"))

    def before(x: Column) -> Column:
        upto = F.transform(x["sums"], lambda _, c: total(F.slice(x["sums"], F.lit(1), c)))
        return F.struct(x["lens"].alias("lens"), x["value"].alias("value"), x["width"].alias("width"), upto.alias("upto"))

    def ends(x: Column) -> Column:
        w = x["width"]
        end = F.transform(x["lens"], lambda _, i: F.get(x["upto"], (i / w).cast("int")) + total(F.slice(x["lens"], (i / w).cast("int") * w + 1, i % w + 1)))
        return F.struct(x["value"].alias("value"), end.alias("end"))

    def places(x: Column) -> Column:
        return F.transform(x["value"], lambda v, i: F.struct((F.get(x["end"], i) - F.length(v)).alias("start"), F.get(x["end"], i).alias("end"), v.alias("value")))

    # one element: each step is evaluated once, not again for every match
    found = F.array(F.struct(lens.alias("lens"), value.alias("value")))
    for step in (chunks, before, ends, places):
        found = F.transform(found, step)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(possible, F.get(found, F.lit(0))).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """kind -> its valid matches."""
    out = {}
    for kind, (pattern, test) in PATTERNS.items():
        spans = spans_of(text, F.lit(pattern), text.rlike(test))
        out[kind] = _only_valid(kind, spans)
    return out


def _only_valid(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _entities(kind: str) -> Column:
    return F.transform(kind, lambda s: _entity(kind, s["value"]))


def _puts(kind: str, put) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"], s["end"], put(s["value"]).alias("put")))


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, text, tkey, email, ip, card, phone`` (arrays of spans); null texts
    are empty.  ``tkey`` tells different texts apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (docs.select(F.col("doc_id"), text.alias("text"))
            .select("doc_id", "text", *[s.alias(k) for k, s in base_spans(F.col("text")).items()])
            .withColumn("any", F.size("email") + F.size("ip") + F.size("card") + F.size("phone") > 0)
            .withColumn("tkey", F.when(F.col("any"), F.md5("text"))))


def _entity(kind: str, value: Column) -> Column:
    plain = F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)
    return F.concat(F.lit(kind + ":"), plain)


def _words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def _share(n_e: Column, n_et: Column, n_t: Column, total: int) -> Column:
    """The disclosed share; null where the entity is in every text."""
    ic = F.log2(F.lit(float(total)) / n_e)
    return F.when(ic > 0, F.log2(F.lit(float(total)) * (n_et + 0.5) / (n_e * (n_t + 1))) / ic)


def _action(share: Column, generalise: float, remove: float) -> Column:
    return F.when(share >= remove, "removed").when(share >= generalise, "generalised")


def telling_words(texts: DataFrame, held: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``tid, start, end, value, action``: the words of ``held(tid, text, copies, entities)``,
    the different texts with entities, that disclose one of them.  ``texts(text)`` is the
    corpus, with copies."""
    total = texts.count()
    corpus = stored(texts.select(F.explode(_words(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t")), "pii-corpus")
    # entities of the same texts are one class
    of = held.select("tid", "copies", F.explode("entities").alias("entity"))
    entities = of.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count("*").alias("texts"),
                                        *[F.sum(F.pmod(F.xxhash64(F.lit(k), "tid"), F.lit(1 << 31))).alias(f"s{k}") for k in (1, 2)])
    classes = stored(of.join(entities, "entity").select("tid", "n_e", "texts", F.xxhash64("n_e", "texts", "s1", "s2").alias("cls")).distinct(), "pii-classes")
    top = classes.agg(F.max("n_e")).first()[0]
    if not total or top is None:
        none = F.lit(None)
        return held.select("tid", none.cast("int").alias("start"), none.cast("int").alias("end"), none.cast("string").alias("value"),
                           none.cast("string").alias("action")).where(F.lit(False))
    bound = (top + 0.5) * (total / top) ** (1 - generalise)
    rare = corpus.where(F.col("n_t") + 1 <= bound)
    common = corpus.where(F.col("n_t") + 1 > bound).orderBy(F.col("n_t").desc(), "term").limit(SENT_WORDS).select("term")

    # every occurrence of a rare word, with its place in the text
    pieces = held.select("tid", F.regexp_extract_all("text", F.lit(PIECE), F.lit(0)).alias("p")).select("tid", F.col("p"), F.transform("p", F.length).alias("n"))
    pieces = pieces.select("tid", F.posexplode("p").alias("i", "piece"), "n").select(
        "tid", "piece", F.aggregate(F.slice("n", F.lit(1), F.col("i")), F.lit(0), lambda s, x: s + x).alias("offset"))
    words = pieces.select("tid", "offset", F.explode(spans_of(F.col("piece"), F.lit(WORD), F.lit(True))).alias("w"))
    words = words.select("tid", (F.col("offset") + F.col("w.start")).cast("int").alias("start"), F.col("w.value").alias("value"), F.lower("w.value").alias("term"))
    words = words.join(F.broadcast(common), "term", "left_anti")
    single = classes.where("texts = 1").select("tid", "n_e")
    words = stored(words.join(rare, "term").select("tid", "start", "value", "term", "n_t"), "pii-words")

    alone = words.join(single, "tid").select("tid", "term", _action(_share(F.col("n_e"), F.col("n_e"), F.col("n_t"), total), generalise, remove).alias("action"))
    # classes of several texts: n(e, t) over their texts
    several = classes.where("texts > 1")
    pairs = (words.select("tid", "term", "n_t").distinct().join(several.select("tid", "cls", "n_e"), "tid")
             .join(held.select("tid", "copies"), "tid"))
    counted = (pairs.groupBy("cls", "n_e", "term", "n_t").agg(F.sum("copies").alias("n_et"))
               .select("cls", "term", _action(_share(F.col("n_e"), F.col("n_et"), F.col("n_t"), total), generalise, remove).alias("action"))
               .where("action is not null"))
    shared = pairs.select("tid", "cls", "term").join(counted, ["cls", "term"]).select("tid", "term", "action")
    actions = alone.where("action is not null").union(shared).groupBy("tid", "term").agg(F.max("action").alias("action"))
    return words.join(actions, ["tid", "term"]).select("tid", "start", (F.col("start") + F.length("value")).alias("end"), "value", "action")


def analyse(docs: DataFrame, **thresholds) -> DataFrame:
    """``doc_id, text, email, ip, card, phone, generalised, removed``: arrays of
    spans ``start, end, value`` by kind, in order of place.

    Null or empty texts have no spans.  Repeated rows each get their spans.
    A word that several entities of the document reach is removed if one of
    them has it removed.  Other columns are ignored.
    """
    found = stored(detect(docs).drop("text"), "pii-base")
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    entities = F.array_distinct(F.concat(*[_entities(k) for k in KINDS]))
    # the different texts that hold an entity, with their number of copies
    held = stored(detect(docs).where("any").select("tkey", "text", entities.alias("entities"))
                  .groupBy("tkey").agg(F.first("text").alias("text"), F.first("entities").alias("entities"),
                                       F.count("*").alias("copies")).withColumn("tid", F.monotonically_increasing_id()), "pii-texts")
    telling = telling_words(texts, held, **thresholds)
    span = F.struct("start", "end", "value")
    more = (telling.groupBy("tid").agg(*[F.array_sort(F.collect_list(F.when(F.col("action") == a, span))).alias(a) for a in ("generalised", "removed")])
            .join(held.select("tid", "tkey"), "tid").drop("tid"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    base = F.concat(*KINDS)

    def outside(kind: str) -> Column:  # words within an entity go with it
        return F.filter(F.coalesce(kind, none), lambda s: ~F.exists(
            base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))

    # texts without entities look nothing up
    some = found.where("tkey is not null").join(more, "tkey", "left").select(
        "doc_id", *KINDS, *[outside(a).alias(a) for a in ("generalised", "removed")])
    return some.union(found.where("tkey is null").select("doc_id", *KINDS, none.alias("generalised"), none.alias("removed")))


def span_list(kinds=KINDS) -> Column:
    """``kind:start:end`` of all spans, by kind as listed, then start."""
    return F.array_join(F.concat(*[_named(k, F.col(k)) for k in kinds]), ",")


def apply_spans(text: Column, spans: Column) -> Column:
    """``text`` with ``array<struct<start, end, put>>`` written over it; of
    overlapping spans the first (then the longest) wins."""
    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    step = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), s["put"]).alias("out"))).otherwise(acc))
    return F.concat(step["out"], F.substring(text, step["at"] + 1, F.length(text)))


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """``doc_id, sanitised``: entities become ``[KIND]``, generalised words their
    initial and an ellipsis, removed words nothing.  One row per document row; null
    texts are empty.  Rows that repeat a doc_id with other texts each get their own
    text sanitised."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("key", F.md5("text"))
    # a row's spans depend on its text alone, so texts stand in for ids; copies count in the statistics
    texts = stored(rows.groupBy("key").agg(F.first("text").alias("text")).withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    spans = analyse(rows.join(texts.select("key", "row"), "key").select(F.col("row").alias("doc_id"), "text"), **thresholds)
    puts = F.concat(*[_puts(k, lambda v, k=k: F.lit(f"[{k.upper()}]")) for k in KINDS],
                    _puts("generalised", lambda v: F.concat(F.substring(v, 1, 1), F.lit("…"))),
                    _puts("removed", lambda v: F.lit("")))
    cleaned = (texts.join(spans.select(F.col("doc_id").alias("row"), puts.alias("puts")).dropDuplicates(["row"]), "row")
               .select("key", apply_spans(F.col("text"), F.col("puts")).alias("sanitised")))
    return rows.select("doc_id", "key").join(cleaned, "key").select("doc_id", "sanitised")
