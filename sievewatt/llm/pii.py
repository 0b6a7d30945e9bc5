"""Personal data in whole texts, with DataFrame functions and MLlib only.

Base spans are fixed: patterns for mail addresses, IPv4 addresses, cards and phones, leftmost and
non-overlapping per kind, each with its check. They always stay. Beyond them, generators propose overlapping
candidates with wide patterns (spelled-out or spaced mail addresses, any grouping of digits); boosted trees judge
each candidate by its format and its surroundings, and sound ones above a threshold are added. A threshold per kind
is the lowest at which, on candidates not used for training, at least :data:`PRECISION` are positives; where no
threshold reaches that, none is added.

Positives are the base spans, and the same spans rewritten in the other forms that the generators know, within their
own surroundings. Negatives are candidates that are not sound (:func:`_sound`: wrong check digit, wrong length, glued
to code, a sentence with "at", a number that nothing tells to be a phone). Sound candidates that are no base spans are
what is to be judged and are not taught. The trees are fitted on one half of all candidates, by a hash, thresholds are
set on all of the other half; their rewritten forms come on top. Candidates of equal features are one weighed row.

Positions are code points. They follow from the lengths of matches and of what is between them, so each pattern
reads a text twice; only texts with a digit or an ``@`` are read. The patterns hold no repeated group: a separator
that counts as part of a match is first replaced by one private character, so long runs need no deep recursion.

Defined results: null and empty texts have no spans; repeated rows are judged each; without candidates of both
classes nothing is added; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewatt.llm.common import durable

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
TREES, DEPTH = 10, 3
# Different rows of features that one task of the fit holds.
ROWS_PER_TASK = 50_000

# A private character that stands for a separator within a match; own uses of it in a text become U+FFFD.
JOINT = ""
_JOINED_DIGITS = r"(?<=[0-9])[\x20-](?=[0-9])"
_JOINED_LABELS = r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])"

# What a base span looks like, on a text with joints where there are any.
EMAIL = f"[A-Za-z0-9._%+{JOINT}-]+@[A-Za-z0-9-]+{JOINT}[A-Za-z0-9{JOINT}-]+"
IP = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = f"[0-9][0-9{JOINT}]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# What the generators propose.
ANY_MAIL = r"[\p{L}0-9._%+-]{1,64}\x20?(?:@|[(\[](?:at|AT)[)\]]|\x20at\x20)\x20?[\p{L}0-9-]{1,63}(?:\x20?(?:[.]|[(\[](?:dot|DOT)[)\]]|\x20dot\x20)\x20?[\p{L}0-9-]{2,63}){1,6}"
ANY_NUMBER = r"(?<![\p{L}0-9])[+(]?[0-9][0-9()\x20./-]{5,60}[0-9](?![\p{L}0-9])"
ANY_DOTTED = r"(?<![\p{L}0-9.])[0-9]{1,3}(?:[.,:_-][0-9]{1,3}){3}(?![\p{L}0-9])"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits ends in the right check digit."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        x = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return acc + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False)


def _phone(m: Column) -> Column:
    return F.length(_digits(m)).between(9, 15)


def _ip(m: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))


def _spans(text: Column, pattern: str, kind: Column | None, check) -> Column:
    """(start, end, kind) of the matches of ``pattern`` that pass ``check``, in order."""
    made = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(gaps.alias("gap"), made.alias("m"))
    blank = "array<struct<start:int,end:int,m:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(blank).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["m"]), F.lit(0))
        item = F.array(F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("m")))
        return F.struct(
            end.alias("at"), F.when(x["m"].isNotNull() & check(x["m"]), F.concat(acc["out"], item)).otherwise(acc["out"]).alias("out")
        )

    found = F.aggregate(pairs, start, add)["out"]
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), (kind if kind is not None else _kind(s["m"])).alias("kind")))


def _kind(m: Column) -> Column:
    """The kind that a candidate would be (number in :data:`KINDS`)."""
    digits = F.length(_digits(m))
    return (
        F.when(m.rlike(r"@|\bat\b|\bAT\b"), 0)
        .when(m.rlike("^[0-9]{1,3}([.,:_-][0-9]{1,3}){3}$"), 1)
        .when((digits >= 12) & ~m.rlike("^([+]|00)"), 2)
        .otherwise(3)
    )


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start and kind."""
    clean = F.translate(text, JOINT, "�")
    labels, numbers = F.regexp_replace(clean, _JOINED_LABELS, JOINT), F.regexp_replace(clean, _JOINED_DIGITS, JOINT)
    nothing = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    anything = lambda m: F.lit(True)
    found = F.concat(
        F.when(F.contains(text, F.lit("@")), _spans(labels, EMAIL, F.lit(0), anything)).otherwise(nothing),
        F.when(text.rlike(r"[0-9]\.[0-9]"), _spans(text, IP, F.lit(1), _ip)).otherwise(nothing),
        F.when(text.rlike("[0-9]"), _spans(numbers, CARD, F.lit(2), _card)).otherwise(nothing),
        F.when(text.rlike(r"\+[0-9]"), _spans(text, PHONE, F.lit(3), _phone)).otherwise(nothing),
    )
    in_order = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.when(text.rlike("[0-9@]"), F.array_sort(in_order)).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int>>")
    )


def candidates(text: Column) -> Column:
    """What the generators propose, with the text of each and what is around it."""
    nothing = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    anything = lambda m: F.lit(True)
    found = F.array_distinct(
        F.concat(
            F.when(text.rlike(r"@|[(\[](?i:at)[)\]]|\x20at\x20\S+\x20?[.]|\x20dot\x20"), _spans(text, ANY_MAIL, F.lit(0), anything)).otherwise(nothing),
            F.when(text.rlike("[0-9][0-9()\\x20./-]{5}"), _spans(text, ANY_NUMBER, None, anything)).otherwise(nothing),
            F.when(text.rlike("[0-9][.,:_-][0-9]"), _spans(text, ANY_DOTTED, F.lit(1), anything)).otherwise(nothing),
        )
    )
    told = F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
            F.substr(text, s["start"] + 1, s["end"] - s["start"]).alias("m"),
            F.substr(text, F.greatest(F.lit(1), s["start"] - 23), F.least(F.lit(24), s["start"])).alias("before"),
            F.substr(text, s["end"] + 1, F.lit(12)).alias("after"),
        ),
    )
    blank = "array<struct<start:int,end:int,kind:int,m:string,before:string,after:string>>"
    return F.when(text.rlike(r"[0-9@]|[(\[](?i:at)[)\]]|\x20at\x20"), told).otherwise(F.array().cast(blank))


def _count(m: Column, pattern: str) -> Column:
    return F.length(m) - F.length(F.regexp_replace(m, pattern, ""))


GLUED_BEFORE, GLUED_AFTER = r"[\p{L}0-9_@.-]$", r"^[\p{L}0-9_@-]"
ASSIGNED = r"(?i)(token|key|secret|hash|id|sha)\W*$"
TOLD = r"(?i)(mail|phone|tel|call|card|visa|contact|fax|ip|addr)\w*\W*$"
AT, DOT = r"\x20?(?:@|[(\[](?:at|AT)[)\]]|\x20at\x20)\x20?", r"\x20?(?:[.]|[(\[](?:dot|DOT)[)\]]|\x20dot\x20)\x20?"


def _sound() -> Column:
    """Whether a candidate passes the checks of its kind in whatever form it is written."""
    m, before, kind = F.col("m"), F.col("before"), F.col("kind")
    written = F.regexp_replace(F.regexp_replace(m, AT, "@"), DOT, ".")
    sentence = m.rlike(r"\x20at\x20") & ~m.rlike(r"\x20dot\x20|(?i)[(\[]dot[)\]]")
    mail = ~sentence & written.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+$")
    phone = _phone(m) & (m.rlike("^([+]|00)|[(]") | before.rlike(TOLD)) & ~m.rlike("^(19|20)[0-9]{2}[-/.]")
    dotted = F.when(m.rlike(r"^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$"), _ip(m)).otherwise(False)
    right = F.when(kind == 0, mail).when(kind == 1, dotted).when(kind == 2, _card(m)).otherwise(phone)
    return right & ~before.rlike(GLUED_BEFORE) & ~F.col("after").rlike(GLUED_AFTER) & ~before.rlike(ASSIGNED)


def _rewritten() -> Column:
    """Other ways to write a base span; none for those that have only one form."""
    m, kind = F.col("m"), F.col("kind")
    name, host = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)

    def mail(at: str, dot: str) -> Column:
        return F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot)))

    digits = _digits(m)
    grouped = lambda sep: F.regexp_replace(digits, "(?<=[0-9])(?=(?:[0-9]{4})+$)", sep)
    bare = F.regexp_replace(m, "^[+]", "")
    return (
        F.when(kind == 0, F.array(mail(" (at) ", "."), mail("[at]", "[dot]"), mail(" at ", " dot "), mail(" @ ", ".")))
        .when(kind == 2, F.array(grouped("."), grouped("/"), grouped(" - ")))
        .when((kind == 3) & m.startswith("+"), F.array(bare, F.concat(F.lit("00"), bare), F.translate(bare, " -", "..")))
        .otherwise(F.array().cast("array<string>"))
    )


def _features() -> dict[str, Column]:
    m, before, after = F.col("m"), F.col("before"), F.col("after")
    digits = _digits(m)
    return {
        "kind_email": F.col("kind") == 0,
        "kind_ip": F.col("kind") == 1,
        "kind_card": F.col("kind") == 2,
        "n_chars": F.length(m),
        "n_digits": F.length(digits),
        "n_kinds_of_digit": F.size(F.array_distinct(F.split(digits, ""))),
        "n_dots": _count(m, "[.]"),
        "n_blanks": _count(m, "\\x20"),
        "n_dashes": _count(m, "-"),
        "n_brackets": _count(m, "[()\\[\\]]"),
        "n_slashes": _count(m, "/"),
        "n_letters": _count(m, "\\p{L}"),
        "plus": m.startswith("+"),
        "zeros": m.startswith("00"),
        "sign": m.contains("@"),
        "longest_group": F.array_max(F.transform(F.split(m, "[^0-9]+"), lambda x: F.length(x))),
        "glued_before": before.rlike(GLUED_BEFORE),
        "glued_after": after.rlike(GLUED_AFTER),
        "quoted": before.rlike("[\"'=]$"),
        "assigned": before.rlike(ASSIGNED),
        "told": before.rlike(TOLD),
        "line_start": before.rlike("\\n$") | (F.length(before) == 0),
    }


def _names() -> list[str]:
    return [f"f_{n}" for n in _features()]


def _with_features(rows: DataFrame) -> DataFrame:
    return rows.select("*", *[c.cast("double").alias(f"f_{n}") for n, c in _features().items()])


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=_names(), outputCol="x").transform(rows).drop(*_names())


def read(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, row, base, proposed) for every row of ``docs``; texts are read once. ``row`` tells texts of one id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return durable(
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), base_spans(text).alias("base"), candidates(text).alias("proposed"))
    )


def proposals(found: DataFrame) -> DataFrame:
    """One row per candidate of each text: its span, its surroundings, whether it is a base span (``label``) and whether
    it meets one (``met``)."""
    texts = found.filter(F.size("proposed") > 0).dropDuplicates(["id", "row"])
    rows = texts.select("id", "row", "base", F.explode("proposed").alias("c")).select("id", "row", "base", "c.*")
    same = F.exists("base", lambda b: (b["start"] == F.col("start")) & (b["end"] == F.col("end")))
    meets = F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    return rows.withColumn("label", same.cast("double")).withColumn("met", meets).drop("base")


def _other_forms(rows: DataFrame) -> DataFrame:
    """The base spans among ``rows`` in other forms, with their surroundings."""
    other = rows.filter("label = 1").withColumn("m", F.explode(_rewritten()))
    return other.withColumn("kind", F.when(F.col("kind") == 0, 0).otherwise(_kind(F.col("m")))).select(*rows.columns)


def lessons(rows: DataFrame) -> DataFrame:
    """(part, kind, label, features..., n): all taught candidates and their other forms, counted by equal features.
    Part 0 is for the trees, 1 for the thresholds; equal texts fall into one part."""
    taught = rows.filter((F.col("label") == 1) | (~F.col("met") & ~_sound()))
    parted = taught.withColumn("part", F.pmod(F.xxhash64("m", "before"), F.lit(2)))
    every = _with_features(parted.unionByName(_other_forms(parted)))
    return every.groupBy("part", "kind", "label", *_names()).agg(F.count(F.lit(1)).cast("double").alias("n"))


def train(rows: DataFrame) -> tuple[GBTClassificationModel, dict[int, float]] | None:
    """The trees and the threshold of each kind, from one half and the other of all candidates."""
    counted = durable(_assembled(lessons(rows)))
    told = counted.filter("part = 0").agg(F.countDistinct("label"), F.count(F.lit(1))).first()
    if told[0] < 2:
        return None
    data = durable(counted.filter("part = 0").select("x", "label", "n")).repartition(-(-told[1] // ROWS_PER_TASK))
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, seed=7, maxMemoryInMB=64)
    model = trees.fit(data)
    percent = F.floor(vector_to_array("probability")[1] * 100).cast("int").alias("p")
    judged = model.transform(counted.filter("part = 1")).select("kind", "label", "n", percent)
    # at most 101 rows for each kind
    bins = judged.groupBy("kind", "p").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()
    least = {}
    for kind in range(len(KINDS)):
        right = n = 0.0
        for r in sorted((b for b in bins if b["kind"] == kind), key=lambda b: -b["p"]):
            right, n = right + r["right"], n + r["n"]
            if right >= PRECISION * n:
                least[kind] = r["p"] / 100
    return model, least


def detect(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, row, base, added) for every row of ``docs``: spans as (start, kind, end), sorted; kinds as in :data:`KINDS`.
    ``row`` tells texts of one id apart."""
    found = read(docs, text_col, id_col)
    rows = durable(proposals(found))
    trained = train(rows)
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if trained is None:
        return found.select("id", "row", "base", nothing.alias("added"))
    model, least = trained
    limit = F.lit(2.0)
    for kind, p in least.items():
        limit = F.when(F.col("kind") == kind, F.lit(p)).otherwise(limit)
    judged = model.transform(_assembled(_with_features(rows.filter(~F.col("met") & _sound())))).filter(vector_to_array("probability")[1] >= limit)
    span = F.struct(F.col("start"), F.col("kind"), F.col("end"))
    added = judged.groupBy("id", "row").agg(F.array_sort(F.collect_set(span)).alias("added"))
    return found.alias("f").join(added.alias("a"), F.expr("f.id <=> a.id AND f.row = a.row"), "left").select(
        "f.id", "f.row", "f.base", F.coalesce("a.added", nothing).alias("added")
    )


def number_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; spans that overlap become one."""
    text = F.coalesce(F.col(f"d.{text_col}"), F.lit(""))
    found = detect(docs, text_col, id_col).dropDuplicates(["id", "row"])
    spans = F.array_sort(F.concat("s.base", "s.added"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        keep = F.when(s["start"] >= acc["at"], F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], keep).alias("out"))

    done = F.aggregate(spans, start, step)
    clean = F.concat(done["out"], F.substr(text, done["at"] + 1, F.length(text)))
    # a text is known by its id and its hash, which a null id does not keep apart from others
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("s.id")) & (F.xxhash64(F.coalesce(F.col(f"d.{text_col}"), F.lit(""))) == F.col("s.row"))
    joined = docs.alias("d").join(found.alias("s"), same, "left")
    kept = [F.col(f"d.{c}") if c != text_col else F.when(F.size(spans) > 0, clean).otherwise(F.col(f"d.{c}")).alias(c) for c in docs.columns]
    return joined.select(*kept)
