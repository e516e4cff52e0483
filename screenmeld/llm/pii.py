"""Personal data by weak supervision. DataFrame operations only.

Candidates are the matches of the base patterns and of looser ones (numbers without a country code, spelled-out mail
addresses, card-like numbers whose check digit fails but whose context names a card). Five labelers vote -1, 0 or 1
on each: the strict pattern, a gazetteer (top-level domains, country codes, issuer prefixes, reserved networks), the
context words before it, the regularity of its shape and its edges. Vote patterns are counted over the whole corpus, a table
of at most 3**5 x buckets rows per kind; expectation-maximisation over these counts estimates how reliable each labeler is, and
the posteriors train a naive Bayes classifier over votes and length. A candidate that
is no base span and overlaps none of its kind is added where the classifier gives it at least ``LEAST``.

Positions come from the pieces between matches: a match starts where the pieces and matches before it end. Patterns are
written so that no start inside a run of characters is tried twice; sums over matches run in blocks, and overlaps with base spans are found by
bisection, so a text with n matches costs about n times the root of n small steps at most.

Defined cases: NULL text is empty and has no spans; rows are scored one by one, so repeated rows and ties need no
rule; a corpus without candidates adds nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.session import stage

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("regex", "gazetteer", "context", "shape", "edge")
LEAST = 0.9
ROUNDS = 25

#: Patterns of candidates. The first four give what leftmost non-overlapping matching of the plain forms gives.
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "loose_email": (rf"(?<!{LOCAL}){LOCAL}++ ?[(\[](?:at|AT)[)\]] ?[A-Za-z0-9-]++"
                    r"(?: ?(?:[(\[](?:dot|DOT)[)\]]|\.) ?[A-Za-z0-9-]++)++"),
    "loose_phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
}
KIND_OF = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "loose_email": EMAIL, "loose_phone": PHONE}
GUARDS = {"email": "@", "phone": "+", "loose_email": "@at", "ip": "", "card": "", "loose_phone": ""}
#: Gazetteers and context words.
DOMAINS = ("com|org|net|edu|gov|mil|int|info|biz|io|co|eu|de|fr|es|it|nl|be|at|ch|uk|ie|pt|pl|se|no|dk|fi|us|ca|mx|br|ar|au|nz|"
           "jp|cn|in|kr|ru|za|example")
COUNTRY_CODES = ("1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|81|82|84|"
                 "86|90|91|92|93|94|95|98|212|213|216|351|352|353|354|358|359|370|371|372|380|385|420|421|971|972")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|62|35)"
RESERVED = r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|22[4-9]|2[3-5][0-9])\."
NEAR = {EMAIL: r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel|kontakt)\b[^\n]{0,20}$",
        IP: r"(?i)\b(?:ip|host|server|address|login|logged|from)\b[^\n]{0,20}$",
        CARD: r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b[^\n]{0,20}$",
        PHONE: r"(?i)\b(?:tel|phone|call|mobile|cell|fax|telefon|téléphone|teléfono|ring)\b[^\n]{0,20}$"}
AGAINST = r"(?i)\b(?:isbn|issn|order|invoice|version|serial|part|model|sku|doi|id|ref)\b[^\n]{0,12}$"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))
    at = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(at, F.lit(0), lambda s, i: s + F.when(
        i % 2 == 0, double(F.substring(digits, i, F.lit(1)).cast("int"))).otherwise(
        F.substring(digits, i, F.lit(1)).cast("int")))
    return total % 10 == 0


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _candidate(name: str, hit: Column, before: Column, after: Column, start: Column) -> Column:
    """Struct of one match: place, whether it is a base span, and the votes on it."""
    kind, loose = KIND_OF[name], name.startswith("loose")
    count = F.length(_digits(hit))
    valid = {EMAIL: F.lit(True), IP: hit.rlike(OCTETS), CARD: luhn(hit), PHONE: (count >= 9) & (count <= 15)}[kind]
    strict = F.lit(-1 if loose else 1) if loose or name == "email" else F.when(valid, 1).otherwise(-1)
    known = {EMAIL: hit.rlike(rf"(?i)(?:\.|[)\]] ?)(?:{DOMAINS})$"), IP: ~hit.rlike(RESERVED),
             CARD: _digits(hit).rlike(ISSUERS),
             PHONE: hit.rlike(r"^\(?[2-9]") if loose else _digits(hit).rlike(f"^(?:{COUNTRY_CODES})")}[kind]
    regular = {EMAIL: ~hit.contains("..") & ~hit.rlike("[.-]@"), IP: ~hit.rlike(r"(?:^|\.)0[0-9]"),
               CARD: hit.rlike(r"^(?:[0-9]+|[0-9]{4}(?:[ -][0-9]{3,7})+)$"), PHONE: ~hit.rlike(r"[ .-]{2}")}[kind]
    near, against = before.rlike(NEAR[kind]), before.rlike(AGAINST)
    clean = ~before.rlike(r"[A-Za-z0-9_/=-]$") & ~after.rlike(r"^[A-Za-z0-9_/=]")
    base = F.lit(False) if loose else valid
    return F.struct(
        start.cast("int").alias("start"), F.lit(kind).alias("kind"), (start + F.length(hit)).cast("int").alias("end"),
        base.alias("base"), (base | (near & ~against) | F.lit(loose)).alias("open"),
        strict.alias("regex"), _vote(known, ~known).alias("gazetteer"), _vote(near & ~against, against).alias("context"),
        _vote(regular, ~regular).alias("shape"), _vote(clean, ~clean).alias("edge"),
        F.least(F.length(hit) / 6, F.lit(4)).cast("int").alias("size"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` reads it inside a function of elements."""
    return F.transform(F.array(value), use)[0]


def sums_before(sizes: Column) -> Column:
    """For each element the sum of the elements before it.

    Sums run inside blocks of about the root of the number of elements and then over the blocks, as a list that grows by an element
    is copied each time.
    """
    start = lambda: F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    add = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))

    def over_blocks(given: Column) -> Column:
        n = F.size(given)
        width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
        firsts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)), width)
        inside = F.transform(firsts, lambda k: F.aggregate(F.slice(given, k, width), start(), add))
        return bound(inside, lambda blocks: F.flatten(F.zip_with(
            blocks, F.aggregate(F.transform(blocks, lambda b: b["at"]), start(), add)["out"],
            lambda b, at: F.transform(b["out"], lambda x: x + at))))
    return bound(sizes, over_blocks)


def overlaps(start: Column, end: Column, starts: Column, ends: Column) -> Column:
    """Whether a span overlaps one of a list of disjoint spans in order, by bisection."""
    def halve(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["a"] + acc["b"], 1)
        below = F.try_element_at(starts, middle + 1) < end
        open_ = acc["a"] < acc["b"]
        return F.struct(F.when(open_ & below, middle + 1).otherwise(acc["a"]).alias("a"),
                        F.when(open_ & ~below, middle).otherwise(acc["b"]).alias("b"))
    before = F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.struct(F.lit(0).alias("a"), F.size(starts).alias("b")), halve)["a"]
    return F.coalesce(F.try_element_at(ends, F.nullif(before, F.lit(0))) > start, F.lit(False))


def _matches(name: str, text: Column) -> Column:
    """Candidates of one pattern in one text."""
    pattern = PATTERNS[name]
    guard = {"@": text.contains("@"), "+": text.contains("+"), "@at": text.rlike(r"[(\[](?:at|AT)[)\]]"),
             "": text.rlike("[0-9].?[0-9]")}[GUARDS[name]]
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), 0)
    parts = F.arrays_zip(hits.alias("hit"), F.slice(pieces, 1, F.size(pieces) - 1).alias("before"),
                         F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))).alias("after"))
    none = F.array().cast("array<struct<hit:string,before:string,after:string>>")
    step = lambda p: F.length(p["before"]) + F.length(p["hit"])
    return bound(F.coalesce(F.when(guard, parts), none), lambda known: F.zip_with(
        known, sums_before(F.transform(known, step)), lambda p, at: _candidate(
            name, p["hit"], F.right(p["before"], F.lit(40)), F.left(p["after"], F.lit(8)), at + F.length(p["before"]))))


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the sorted array ``found`` of every row."""
    text = F.coalesce("text", F.lit(""))
    found = F.concat(*[_matches(name, text) for name in PATTERNS])
    return docs.select("doc_id", F.array_sort(F.filter(found, lambda c: c["open"])).alias("found"))


def reliabilities(votes: list[tuple[tuple[int, ...], float]]) -> tuple[list[dict[int, float]], list[float]]:
    """EM over counted vote patterns: log-odds of each labeler's votes, and each pattern's posterior."""
    post = [1 / (1 + math.exp(-1.0 * sum(v))) for v, _ in votes]
    odds: list[dict[int, float]] = []
    for _ in range(ROUNDS):
        yes = sum(p * n for p, (_, n) in zip(post, votes)) + 1.0
        no = sum((1 - p) * n for p, (_, n) in zip(post, votes)) + 1.0
        odds = []
        for k in range(len(LABELERS)):
            # smoothing leans to the belief that labelers are right more often than not
            for_, against = {-1: 0.5, 0: 1.0, 1: 2.0}, {-1: 2.0, 0: 1.0, 1: 0.5}
            for p, (v, n) in zip(post, votes):
                for_[v[k]] += p * n
                against[v[k]] += (1 - p) * n
            odds.append({x: math.log(for_[x] / (yes + 3.5)) - math.log(against[x] / (no + 3.5)) for x in (-1, 0, 1)})
        prior = math.log(yes / no)
        post = [1 / (1 + math.exp(-max(-30.0, min(30.0, prior + sum(o[x] for o, x in zip(odds, v)))))) for v, _ in votes]
    return odds, post


def train(found: DataFrame) -> dict[str, float]:
    """Weights ``kind|feature|value`` of the final classifier, from vote counts over the whole corpus."""
    names = [*LABELERS, "size"]
    counted = (found.select(F.explode("found").alias("c")).select("c.kind", *[f"c.{n}" for n in names])
               .groupBy("kind", *names).count().collect())  # at most 3**5 x 5 rows per kind
    weights: dict[str, float] = {}
    for kind in range(len(KINDS)):
        rows = [r for r in counted if r["kind"] == kind]
        votes = [(tuple(r[n] for n in LABELERS), float(r["count"])) for r in rows]
        if not votes:
            continue
        _, post = reliabilities(votes)
        yes = sum(p * n for p, (_, n) in zip(post, votes))
        no = sum(n for _, n in votes) - yes
        weights[f"{kind}|prior"] = math.log((yes + 1) / (no + 1))
        for name in names:
            sums = defaultdict(lambda: [0.5, 0.5])
            for p, (_, n), r in zip(post, votes, rows):
                sums[r[name]][0] += p * n
                sums[r[name]][1] += (1 - p) * n
            for value, (a, b) in sums.items():
                weights[f"{kind}|{name}|{value}"] = math.log(a / (yes + 1)) - math.log(b / (no + 1))
    return weights


def probability(c: Column, weights: dict[str, float]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in (weights or {"": 0.0}).items() for x in pair])
    get = lambda *key: F.coalesce(table[F.concat_ws("|", *key)], F.lit(0.0))
    kind = c["kind"].cast("string")
    score = get(kind, F.lit("prior"))
    for name in (*LABELERS, "size"):
        score = score + get(kind, F.lit(name), c[name].cast("string"))
    return 1 / (1 + F.exp(-score))


def personal_data(docs: DataFrame) -> DataFrame:
    """Base counts, the digest of the base spans and all spans of every row."""
    found = stage(candidates(docs), "pii")
    weights = train(found)
    base = F.filter("found", lambda c: c["base"])
    # spans of one kind of base are disjoint
    of = lambda kind, end: F.transform(F.filter("found", lambda c: c["base"] & (c["kind"] == kind)), lambda c: c[end])
    known = F.struct("found", *[of(k, end).alias(f"{end}{k}") for k in range(len(KINDS)) for end in ("start", "end")])

    def added(s: Column) -> Column:
        taken = lambda c: reduce(lambda rest, k: F.when(c["kind"] == k, overlaps(
            c["start"], c["end"], s[f"start{k}"], s[f"end{k}"])).otherwise(rest), range(len(KINDS)), F.lit(False))
        return F.filter(s["found"], lambda c: c["base"] | ((probability(c, weights) >= LEAST) & ~taken(c)))
    rows = found.select("doc_id", base.alias("base"), bound(known, added).alias("every"))
    every = F.col("every")
    joined = lambda spans: F.array_join(F.transform(spans, lambda c: F.concat_ws(
        ":", F.get(F.array(*[F.lit(k) for k in KINDS]), c["kind"]), c["start"].cast("string"), c["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                       F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"),
                       (F.size(every) - F.size("base")).cast("long").alias("n_added"))
