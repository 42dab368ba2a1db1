"""Personal data: fixed patterns, and weak supervision for the rest.

Base spans (email, ip, card, phone) follow fixed patterns with checks. Other
candidates (secrets, phone numbers without a plus, disguised addresses) are
judged by three labelers: a regex on the candidate's shape, a gazetteer of
known prefixes, domains and ranges, and the words just before it. Each votes
yes, no or not at all, on base spans too. Expectation-maximisation over the
counts of vote patterns estimates how reliable each labeler is and how likely
each pattern is personal data; those probabilities train a naive Bayes
classifier on features of the span, which decides on the candidates.

Only DataFrame functions touch rows. A pattern cuts the text into gaps and
hits (``split`` and ``regexp_extract_all`` find the same matches), and a
hit's position is the length of all before it. The model is fitted on a table
of at most a few thousand counts. Patterns are written so that no text makes
them slow: a run of characters is entered at its start only, and repeated
groups become one character class after separators inside a match have been
replaced by characters of the private use area.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import documents, stored

KINDS = ["email", "ip", "card", "phone"]
ADDED = ["secret", "phone_local", "email_hidden"]
#: Characters before a hit that the context labeler reads.
CONTEXT = 40
#: Probability from which a candidate becomes a span.
ACCEPT = 0.5
#: Hits whose positions are added up at once.
STEP = 256

# Noncharacters that stand for separators inside a hit.
_DOT, _BLANK, _DASH = "\ufdd0", "\ufdd1", "\ufdd2"
_SEP = _BLANK + _DASH
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    #: Texts that may hold a hit at all.
    trigger: str
    #: Separators inside a hit and what stands for them, of the same length.
    inner: tuple[tuple[str, str], ...]
    pattern: str


# The base patterns are those of the query's contract.
PATTERNS = {
    "email": Kind("@", ((r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT),),
                  rf"(?:(?<![A-Za-z0-9._%+\-{_DOT}])|\G)[A-Za-z0-9._%+\-{_DOT}]++@[A-Za-z0-9-]++{_DOT}"
                  rf"[A-Za-z0-9{_DOT}-]++"),
    "ip": Kind(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", (), r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": Kind(r"[0-9](?:[\x20-]?[0-9]){11}", ((r"(?<=[0-9])\x20(?=[0-9])", _BLANK), (r"(?<=[0-9])-(?=[0-9])", _DASH)),
                 rf"[0-9][0-9{_SEP}]{{11,}}"),
    "phone": Kind(r"\+[0-9]", (), r"\+[0-9][\x20().0-9-]+[0-9]"),
    "secret": Kind(r"[0-9][A-Za-z_]|[A-Za-z_][0-9]", (), r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{20,}+"),
    "phone_local": Kind(r"[0-9][\x20.-][0-9]{3,4}", (),
                        r"(?<![0-9+().-])(?<![0-9+().-]\x20)(?:\([0-9]{2,4}\)\x20?)?[0-9]{3,4}"
                        r"(?:[\x20.-][0-9]{3,4}){1,2}(?![0-9.-])"),
    "email_hidden": Kind(r"[(\[](?:at|AT)[)\]]", (),
                         r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]{1,63}"
                         r"\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z]{2,24}"),
}

# Fixed values of the gazetteers: secrets' prefixes, reserved address ranges,
# card issuers, dialling codes, common top domains.
SECRET_PREFIX = r"^(?:AKIA|ASIA|AIza|ghp_|gho_|sk_live_|sk_test_|xox|eyJ|glpat)"
RESERVED_IP = r"^0*(?:0|10|127|255|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|^192\.168\.|^169\.254\."
CARD_ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|30)"
DIAL_CODE = r"^\+(?:1|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
TOP_DOMAIN = r"(?i)[.](?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us)$"
# Words that announce personal data, in the corpus' languages.
CUES = (r"(?i)(?:token|secret|passw|pwd|api.?key|\bkey\b|auth|bearer|credential|phone|tel\b|tel\.|téléphone|telefon|"
        r"teléfono|call|mobile|fax|contact|card|karte|carte|tarjeta|visa|iban|e-?mail|correo|courriel|write to|\bip\b|"
        r"host|server|address|adresse|dirección|from|login)\W{0,12}\w{0,12}\W{0,4}$")


def _gaps_and_hits(docs: DataFrame, kind: str, text: str) -> DataFrame:
    """Adds arrays gaps (one more than hits) and hits of a kind."""
    k = PATTERNS[kind]
    given = F.when(F.col(text).rlike(k.trigger), F.col(text)).otherwise("")
    if k.inner:
        given = F.translate(given, _DOT + _SEP, "???")
    for inner, stands in k.inner:
        given = F.regexp_replace(given, inner, stands)
    docs = docs.withColumn("_t", given)
    docs = docs.withColumn("_g", F.split("_t", k.pattern, -1)).withColumn(
        "_h", F.regexp_extract_all("_t", F.lit(k.pattern), F.lit(0))).drop("_t")
    if k.inner:
        for name in ("_g", "_h"):
            docs = docs.withColumn(name, F.transform(name, lambda x: F.translate(x, _DOT + _SEP, ". -")))
    return docs


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    """Whether a base hit passes its check."""
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        d = _digits(hit)
        return F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind == "secret":
        return hit.rlike("[0-9]")
    if kind == "phone_local":
        return F.length(_digits(hit)).between(7, 11)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _labels(kind: str, hit: Column, before: Column) -> dict[str, Column]:
    """Votes (1, 0, or -1 for none) and features of a hit."""
    never = F.lit(False)
    if kind in ("email", "email_hidden"):
        regex, known = _vote(F.lit(kind == "email"), F.length(hit) > 80), _vote(hit.rlike(TOP_DOMAIN), never)
    elif kind == "ip":
        regex, known = F.lit(1), _vote(~hit.rlike(RESERVED_IP), hit.rlike(RESERVED_IP))
    elif kind == "card":
        regex, known = F.lit(1), _vote(_digits(hit).rlike(CARD_ISSUER), ~_digits(hit).rlike(CARD_ISSUER))
    elif kind == "phone":
        regex, known = F.lit(1), _vote(hit.rlike(DIAL_CODE), ~hit.rlike(DIAL_CODE))
    elif kind == "secret":
        dense = F.length(_digits(hit)) * 8 >= F.length(hit)
        regex = _vote(hit.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$") | (dense & hit.rlike("[A-Z]") & hit.rlike("[a-z]")),
                      hit.rlike("__") | hit.rlike("^[0-9]+$") | ~dense)
        known = _vote(hit.rlike(SECRET_PREFIX), never)
    else:
        regex = _vote(hit.rlike(r"^(?:\([0-9]{3}\)\x20?)?[0-9]{3}[\x20.-][0-9]{4}$|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$"),
                      hit.rlike(r"^(?:1[5-9]|20)[0-9]{2}[\x20.-]"))
        known = _vote(hit.rlike(r"^\([0-9]{3}\)"), never)
    size = F.length(hit)
    return {
        "regex": regex, "gazetteer": known, "context": _vote(before.rlike(CUES), F.length(F.trim(before)) >= 12),
        "size": F.when(size < 12, 0).when(size < 20, 1).when(size < 32, 2).otherwise(3),
        "density": F.floor(F.lit(4) * F.length(_digits(hit)) / (size + 1)).cast("int"),
        "quoted": before.rlike("[\"'=:]\\s*$").cast("int"),
    }


VOTES = ["regex", "gazetteer", "context"]
FEATURES = [*VOTES, "size", "density", "quoted"]


def _with_starts(docs: DataFrame) -> DataFrame:
    """Adds _s: each hit's position, the length of all gaps and hits before.

    Added up STEP hits at a time, so that the arrays being built stay short
    for texts with very many hits. What a lambda reads is a column first.
    """
    part = F.zip_with(F.transform("_g", F.length), F.transform("_h", F.length),
                      lambda g, h: F.struct(g.alias("g"), F.coalesce(h, F.lit(0)).alias("h")))
    steps = F.sequence(F.lit(0), F.floor((F.size("_h") - 1) / STEP).cast("int"))

    def chunk(s: Column) -> Column:
        return F.slice("_p", s * STEP + 1, STEP)

    totals = F.transform(steps, lambda s: F.aggregate(chunk(s), F.lit(0), lambda a, x: a + x["g"] + x["h"]))
    inner = F.transform(steps, lambda s: F.aggregate(
        chunk(s), F.struct(F.get("_b", s).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.struct((a["at"] + x["g"] + x["h"]).alias("at"),
                              F.concat(a["out"], F.array(a["at"] + x["g"])).alias("out")))["out"])
    some, none = F.size("_h") > 0, F.array().cast("array<int>")
    docs = docs.withColumn("_p", part).withColumn("_b", F.when(some, F.aggregate(
        totals, F.array(F.lit(0)), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t)))))
    return docs.withColumn("_s", F.when(some, F.slice(F.flatten(inner), 1, F.size("_h"))).otherwise(none)).drop("_p", "_b")


def _found(docs: DataFrame, kind: str, text: str) -> DataFrame:
    """Adds column ``kind``: structs of start, end and labels of valid hits."""
    docs = _with_starts(_gaps_and_hits(docs, kind, text))
    order = (KINDS + ADDED).index(kind)

    def span(i: Column) -> Column:
        hit, start = F.get("_h", i), F.get("_s", i)
        named = _labels(kind, hit, F.right(F.get("_g", i), F.lit(CONTEXT)))
        return F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
                        (start + F.length(hit)).alias("end"), *[c.alias(n) for n, c in named.items()],
                        _valid(kind, hit).alias("ok"))

    every = F.when(F.size("_h") > 0, F.transform(F.sequence(F.lit(0), F.size("_h") - 1), span))
    schema = ("array<struct<start:int,order:int,kind:string,end:int,"
              + ",".join(f"{f}:int" for f in FEATURES) + ",ok:boolean>>")
    every = F.coalesce(every.cast(schema), F.array().cast(schema))
    return docs.withColumn(kind, F.filter(every, lambda s: s["ok"])).drop("_g", "_h", "_s")


def estimate(rows: list[tuple[tuple, float]], rounds: int = 40) -> tuple[float, list[dict], list[float]]:
    """Dawid-Skene for two classes over vote patterns with counts.

    Returns the prior, each labeler's vote probabilities by (class, vote),
    and the probability of each row's pattern. It starts from the share of
    yes among the votes cast.
    """
    width = len(rows[0][0]) if rows else 0
    belief = [0.5 if not (cast := [v for v in votes if v >= 0]) else 0.1 + 0.8 * sum(cast) / len(cast)
              for votes, _ in rows]
    prior, tables = 0.5, [{} for _ in range(width)]
    for _ in range(rounds):
        mass = [sum(n * b for (_, n), b in zip(rows, belief, strict=True)),
                sum(n * (1 - b) for (_, n), b in zip(rows, belief, strict=True))]
        prior = (mass[0] + 1) / (sum(mass) + 2)
        for k in range(width):
            for c in (0, 1):
                for v in (-1, 0, 1):
                    hit = sum(n * (b if c == 0 else 1 - b) for (votes, n), b in zip(rows, belief, strict=True)
                              if votes[k] == v)
                    tables[k][c, v] = (hit + 1) / (mass[c] + 3)
        belief = []
        for votes, _ in rows:
            odds = math.log(prior) - math.log(1 - prior)
            odds += sum(math.log(tables[k][0, v]) - math.log(tables[k][1, v]) for k, v in enumerate(votes))
            belief.append(1 / (1 + math.exp(-max(-50.0, min(50.0, odds)))))
    return prior, tables, belief


def train(spans: DataFrame) -> dict:
    """Naive Bayes weights from spans (kind and FEATURES columns).

    The table is counted first: at most 7 kinds times 27 vote patterns times
    40 feature values reach the driver.
    """
    counted = [(r["kind"], tuple(r[f] for f in FEATURES), r["n"]) for r in
               spans.groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).orderBy("kind", *FEATURES).collect()]
    votes = [(values[:len(VOTES)], n) for _, values, n in counted]
    prior, _, belief = estimate(votes)
    weights: dict = {"bias": math.log(prior) - math.log(1 - prior)}
    yes, no = (sum(n * b for (*_, n), b in zip(counted, belief, strict=True)),
               sum(n * (1 - b) for (*_, n), b in zip(counted, belief, strict=True)))
    for at, name in enumerate(FEATURES):
        domain = sorted({values[at] for _, values, _ in counted} | ({-1, 0, 1} if name in VOTES else set()))
        for v in domain:
            pro = sum(n * b for (_, x, n), b in zip(counted, belief, strict=True) if x[at] == v)
            con = sum(n * (1 - b) for (_, x, n), b in zip(counted, belief, strict=True) if x[at] == v)
            weights[name, v] = (math.log((pro + 1) / (yes + len(domain)))
                                - math.log((con + 1) / (no + len(domain))))
    return weights


def _accepted(weights: dict, span: Column) -> Column:
    odds = F.lit(float(weights["bias"]))
    for name in FEATURES:
        value = F.lit(0.0)
        for key, w in weights.items():
            if key[0] == name and isinstance(key, tuple):
                value = F.when(span[name] == key[1], w).otherwise(value)
        odds = odds + value
    return odds >= math.log(ACCEPT / (1 - ACCEPT))


def _with_spans(rows: DataFrame) -> DataFrame:
    """Adds base (sorted spans of text) and more (candidates off the base)."""
    kept = rows.columns
    for kind in KINDS + ADDED:
        rows = _found(rows, kind, "text")
    rows = rows.select(*kept, F.array_sort(F.concat(*KINDS)).alias("base"), F.array_sort(F.concat(*ADDED)).alias("more"))
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return rows.withColumn("more", apart)


def _candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base and more of each row."""
    return _with_spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).drop("text")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _model(found: DataFrame) -> dict:
    return train(found.select(F.explode(F.concat("base", "more")).alias("s")).select("s.*"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    One row for each row of ``docs`` (doc_id, text; other columns are
    ignored). Positions are code points, the end exclusive. A null text
    counts as empty: no spans, and the digest of the empty string. Repeated
    rows are each searched; they weigh in the model as often as they occur.
    """
    found = stored(_candidates(docs), "spans")
    weights = _model(found)
    more = F.filter("more", lambda s: _accepted(weights, s))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.array_sort(F.concat("base", more))).alias("spans"))


def _with_runs(rows: DataFrame) -> DataFrame:
    """Adds _r: the runs (start, end, kind) that the sorted spans _s cover
    together, each with the kind of its first span.

    A span begins a run if it starts at or after every end before it; those
    largest ends are found STEP spans at a time, so that no long array is
    built element by element.
    """
    steps = F.sequence(F.lit(0), F.floor((F.size("_s") - 1) / STEP).cast("int"))
    rows = rows.withColumn("_p", F.transform("_s", lambda s: s["end"]))

    def chunk(g: Column) -> Column:
        return F.slice("_p", g * STEP + 1, STEP)

    none = F.array().cast("array<int>")
    rows = rows.withColumn("_b", F.aggregate(
        F.transform(steps, lambda g: F.array_max(chunk(g))), F.array(F.lit(0)),
        lambda a, t: F.concat(a, F.array(F.greatest(F.element_at(a, -1), t)))))
    inner = F.transform(steps, lambda g: F.aggregate(
        chunk(g), F.struct(F.get("_b", g).alias("at"), none.alias("out")),
        lambda a, e: F.struct(F.greatest(a["at"], e).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"])
    # The largest end before each span, and that of all.
    rows = rows.withColumn("_m", F.concat(F.flatten(inner), F.array(F.array_max("_p"))))
    rows = rows.withColumn("_k", F.filter(F.sequence(F.lit(0), F.size("_s") - 1),
                                          lambda i: F.get("_s", i)["start"] >= F.get("_m", i)))
    run = F.transform("_k", lambda i, at: F.struct(
        F.get("_s", i)["start"].alias("start"),
        F.get("_m", F.coalesce(F.get("_k", at + 1), F.size("_s"))).alias("end"), F.get("_s", i)["kind"].alias("kind")))
    return rows.withColumn("_r", run).drop("_p", "_b", "_m", "_k")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span that ``find`` reports replaced by its kind, as [EMAIL].

    The text is cut once: spans that overlap are one piece, which becomes the
    kind of the first of them (the earlier start, then the order of KINDS and
    ADDED), so that no part of any span stays. All other characters and
    columns are kept as they are; a null text stays null. Repeated rows are
    redacted each; an empty table stays empty.
    """
    # The caller's row is one column, so that no name of its columns clashes.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    found = stored(_with_spans(docs.select(others.alias("row"), F.col("text").alias("text"))), "spans")
    weights = _model(found)
    spans = F.array_sort(F.concat("base", F.filter("more", lambda s: _accepted(weights, s))))
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    rows = found.select("row", "text", spans.alias("_s"))
    # A text without spans has one of no width, for whole arrays below; it is not cut.
    rows = rows.withColumn("_some", F.size("_s") > 0).withColumn("_s", F.when(F.col("_some"), F.col("_s")).otherwise(
        F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("kind")))))
    rows = _with_runs(rows)

    def start(i: Column) -> Column:
        return F.coalesce(F.get("_r", i)["start"], F.length("text"))

    def part(g: Column) -> Column:
        since = start(g * STEP)
        return F.struct(since.alias("at"), F.substr("text", since + 1, start((g + 1) * STEP) - since).alias("part"))

    def shown(p: Column, g: Column) -> Column:
        return F.array_join(F.transform(F.slice("_r", g * STEP + 1, STEP), lambda r, at: F.concat(
            F.lit("["), F.upper(F.element_at(F.split(r["kind"], "_"), 1)), F.lit("]"),
            F.substr(p["part"], r["end"] - p["at"] + 1, start(g * STEP + at + 1) - r["end"]))), "")

    # STEP runs at a time, each from its own part of the text: positions are counted from a text's start.
    steps = F.sequence(F.lit(0), F.floor((F.size("_r") - 1) / STEP).cast("int"))
    rows = rows.withColumn("_p", F.when(F.col("_some"), F.transform(steps, part)))
    cut = F.concat(F.substr("text", F.lit(1), start(F.lit(0))), F.array_join(F.transform("_p", shown), ""))
    text = F.when(F.col("_some"), cut).otherwise(F.col("text"))
    return rows.select(*[text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op4_pii(spark, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir))
