"""Personal data by weak supervision, in DataFrame functions only.

Four kinds (email, ip, card, phone) have exact base patterns whose spans are always
reported. Looser candidates (runs that fail a base check, hosts without a dot,
spelled-out addresses, phone numbers without a plus) are decided by the method:
labelers vote on every candidate, expectation-maximisation over the vote patterns
estimates how reliable each labeler is and how likely each pattern is real, and a
logistic span classifier is fitted to those likelihoods and applied.

Spans are found with two regular-expression calls a kind: ``split`` gives the text
between matches and ``regexp_extract_all`` the matches; adding up their lengths gives
code-point offsets. Patterns are the stated ones in possessive form (the same
matches), so that a long run of digits or letters costs linear time and no stack.
The driver sees only the counts of vote patterns, at most ``4 * 3^4 * 2`` rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("regex", "gazetteer", "context", "shape")

_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Only runs of 12 digits or more: shorter ones are dropped anyway, and a run matches whole.
CARD = r"[0-9](?:[\x20-]?+[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
HOST = rf"(?<!{_LOCAL}){_LOCAL}++@[A-Za-z0-9-]++(?!\.?[A-Za-z0-9-])"
SPELLED = (r"(?i)(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++"
           r"(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)+")
LOCAL_PHONE = r"(?<![0-9+(.@-])\(?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-][0-9]{3,4}(?![0-9])"

# Gazetteers and cue words.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "int", "info", "biz", "io", "co", "eu", "de", "fr", "es", "uk", "us",
             "ca", "it", "nl", "be", "at", "ch", "pt", "br", "mx", "ar", "au", "nz", "jp", "cn", "in", "ru", "pl", "se")
CALLING_CODE = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CARD_ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|62|35)"
SPECIAL_IP = r"^(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CUES = {
    "email": r"(mail|contact|write to|kontakt|contacto|courriel|correo|schreib)",
    "ip": r"(\bip\b|host|server|address|adresse|login from|client)",
    "card": r"(card|visa|credit|karte|carte|tarjeta|payment)",
    "phone": r"(phone|tel\b|tel\.|call|fax|mobile|telefon|anruf|llam|appel)",
}
AGAINST = r"(version|isbn|issn|order|invoice|\bno\.? ?$|\bid:? ?$|\bv$|serial|rev\.? ?$)"


def _matches(text: Column, pattern: str, guard: Column) -> Column:
    """Array of (start, end, value, before) of all matches, empty where ``guard`` fails."""
    kind = "array<struct<start:long,end:long,value:string,before:string>>"
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda g, v: F.struct(g.alias("g"), v.alias("v")))
    none = F.array().cast(kind)

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["g"])
        end = start + F.coalesce(F.char_length(x["v"]), F.lit(0))
        one = F.struct(start.alias("start"), end.alias("end"), x["v"].alias("value"),
                       F.lower(F.right(x["g"], F.lit(24))).alias("before"))
        return F.struct(end.cast("long").alias("at"),
                        F.when(x["v"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one)))
                        .alias("out"))

    walked = F.aggregate(parts, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), add,
                         lambda acc: acc["out"])
    return F.when(guard, walked).otherwise(none)


def _luhn(digits: Column) -> Column:
    """Luhn's check on a string of digits."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(
        i % 2 == 1, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), x.cast("int") + 1))
        .otherwise(x.cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10 == 0


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _candidates(text: Column) -> Column:
    """All candidates of a text with their votes, as one array."""
    def digits(v):
        return F.regexp_replace(v, "[^0-9]", "")

    def build(kind: str, found: Column, base, gazetteer, shape, strict: bool = True) -> Column:
        def one(m: Column) -> Column:
            v = m["value"]
            is_base = base(v) if strict else F.lit(False)
            return F.struct(
                m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"),
                is_base.alias("base"),
                _vote(is_base, F.lit(strict)).alias("regex"), gazetteer(v).alias("gazetteer"),
                _vote(m["before"].rlike(CUES[kind]), m["before"].rlike(AGAINST)).alias("context"),
                shape(v).alias("shape"))
        return F.transform(found, one)

    def octets_ok(v):
        return F.forall(F.split(v, r"\."), lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.try_to_number(F.right(p, F.lit(3)), F.lit("999")).cast("int"), F.lit(0)) <= 255))

    many = F.char_length
    has_at, has_digit = text.contains("@"), text.rlike("[0-9][ .-]?[0-9]")
    same = r"^(.)\1*$"
    tld = F.lit("(?i)[.](?:" + "|".join(TOP_LEVEL) + ")$")
    email_shape = lambda v: _vote(F.regexp_like(v, F.lit("^[A-Za-z][^@]*@[^-]")), v.rlike("^[._%+-]|@-"))
    phone_shape = lambda v: _vote(many(digits(v)).between(10, 13) & ~digits(v).rlike(same),
                                  digits(v).rlike(same) | (many(digits(v)) < 7))
    return F.concat(
        build("email", _matches(text, EMAIL, has_at), lambda v: F.lit(True),
              lambda v: _vote(F.regexp_like(v, tld), F.lit(True)), email_shape),
        build("ip", _matches(text, IP, has_digit & text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), octets_ok,
              lambda v: _vote(~v.rlike(SPECIAL_IP), F.lit(True)),
              lambda v: _vote(~v.rlike(r"(^|\.)0[0-9]"), F.lit(True))),
        build("card", _matches(text, CARD, has_digit & text.rlike(CARD)),
              lambda v: many(digits(v)).between(12, 19) & _luhn(digits(v)),
              lambda v: _vote(digits(v).rlike(CARD_ISSUER), F.lit(True)),
              lambda v: _vote(many(digits(v)).between(13, 16) & ~digits(v).rlike(same),
                              digits(v).rlike(same) | (many(digits(v)) > 19))),
        build("phone", _matches(text, PHONE, text.contains("+")), lambda v: many(digits(v)).between(9, 15),
              lambda v: _vote(v.rlike(CALLING_CODE), F.lit(True)), phone_shape),
        build("email", _matches(text, HOST, has_at), None, lambda v: _vote(F.lit(False), F.lit(True)), email_shape,
              strict=False),
        build("email", _matches(text, SPELLED, text.rlike(r"(?i)[ (\[]dot[ )\]]")), None,
              lambda v: _vote(F.regexp_like(v, F.lit("(?i)[ )\\]](?:" + "|".join(TOP_LEVEL) + ")$")), F.lit(True)),
              lambda v: _vote(v.rlike(r"(?i)[(\[]"), F.lit(False)), strict=False),
        build("phone", _matches(text, LOCAL_PHONE, has_digit & text.rlike(LOCAL_PHONE)), None,
              lambda v: F.lit(0), phone_shape, strict=False))


@dataclass(frozen=True)
class Pattern:
    """One combination of kind, base flag and votes, and how often it occurs."""

    kind: int
    base: bool
    votes: tuple[int, ...]
    n: int


def reliabilities(patterns: list[Pattern], rounds: int = 50) -> dict[Pattern, float]:
    """Chance that each pattern is personal data, by expectation-maximisation.

    Per kind, a labeler that speaks is right with a probability of its own for real
    and for false candidates (two-coin model with abstention); votes are independent
    given the truth. It starts from the vote balance, and half a count of right votes
    smooths every estimate.
    """
    post = {p: 1 / (1 + math.exp(-1.5 * sum(p.votes))) for p in patterns}
    for kind in range(len(KINDS)):
        own = [p for p in patterns if p.kind == kind]
        if not own:
            continue
        for _ in range(rounds):
            total = sum(p.n for p in own)
            prior = (sum(p.n * post[p] for p in own) + 1) / (total + 2)
            says = {}
            for j in range(len(LABELERS)):
                for v in (-1, 0, 1):
                    real = sum(p.n * post[p] for p in own if p.votes[j] == v)
                    false = sum(p.n * (1 - post[p]) for p in own if p.votes[j] == v)
                    says[j, v] = ((real + (1.5 if v == 1 else 0.5)) / (prior * total + 2.5),
                                  (false + (1.5 if v == -1 else 0.5)) / ((1 - prior) * total + 2.5))
            moved = 0.0
            for p in own:
                logit = math.log(prior / (1 - prior)) + sum(
                    math.log(says[j, v][0] / says[j, v][1]) for j, v in enumerate(p.votes))
                new = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
                moved = max(moved, abs(new - post[p]))
                post[p] = new
            if moved < 1e-9:
                break
    return post


def _features(kind: int, votes: tuple[int, ...]) -> list[float]:
    return ([float(kind == k) for k in range(len(KINDS))] + [float(v == 1) for v in votes]
            + [float(v == -1) for v in votes])


def train(patterns: list[Pattern], steps: int = 300, l2: float = 1e-3) -> list[float]:
    """Weights of the logistic span classifier fitted to the patterns' likelihoods."""
    width = len(KINDS) + 2 * len(LABELERS)
    w = [0.0] * width
    post = reliabilities(patterns)
    # Pattern weights grow with the logarithm of their count: common ones do not drown the rest.
    rows = [(_features(p.kind, p.votes), post[p], math.log1p(p.n)) for p in patterns]
    total = sum(n for *_, n in rows) or 1.0
    for _ in range(steps):
        grad = [l2 * x for x in w]
        for x, y, n in rows:
            z = sum(a * b for a, b in zip(x, w, strict=True))
            e = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y)
            for j, v in enumerate(x):
                if v:
                    grad[j] += e * v
        w = [a - 2.0 * g for a, g in zip(w, grad, strict=True)]
    return w


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data in each row of ``docs`` (doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans
    (base and added ones, ``kind:start:end`` by start then kind, comma-joined) and
    n_added. Offsets count code points from 0, ends exclusive.

    NULL and empty texts have no spans. Every row counts for itself, repeated rows and
    NULL ids included. Added spans never overlap a base span; of added spans that
    overlap each other, of any kind, all are reported.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(docs.select("doc_id", _candidates(text).alias("found")), "pii-candidates")
    votes = [F.col(f"c.{name}") for name in LABELERS]
    counted = (rows.select(F.explode("found").alias("c"))
               .groupBy(F.col("c.kind").alias("kind"), F.col("c.base").alias("base"),
                        *(v.alias(n) for v, n in zip(votes, LABELERS, strict=True)))
               .agg(F.count("*").alias("n")).collect())  # at most 4 kinds x 2 x 3^4 votes
    patterns = sorted((Pattern(r.kind, r.base, tuple(r[n] for n in LABELERS), r.n) for r in counted),
                      key=lambda p: (p.kind, p.base, p.votes))
    w = train(patterns)
    k = len(KINDS)

    def real(c: Column) -> Column:
        score = F.element_at(F.array(*map(F.lit, w[:k])), c["kind"] + 1)
        for j, name in enumerate(LABELERS):
            score = score + F.when(c[name] == 1, w[k + j]).when(c[name] == -1, w[k + len(LABELERS) + j]).otherwise(0.0)
        return score >= 0

    def of_kind(i: int):
        return lambda c: c["kind"] == i

    base = F.filter("found", lambda c: c["base"])
    plain = lambda a: F.transform(a, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"),
                                                        c["end"].alias("end")))
    added = F.filter(F.col("found"), lambda c: ~c["base"] & real(c) & ~F.exists(
        F.col("bases"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    names = F.array(*map(F.lit, KINDS))
    listed = lambda a: F.array_join(F.transform(F.sort_array(a), lambda c: F.concat_ws(
        ":", F.element_at(names, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))), ",")
    out = rows.withColumn("bases", base)
    out = out.select("doc_id", "bases", F.array_distinct(plain(added)).alias("extra"))
    return out.select(
        "doc_id",
        *(F.size(F.filter("bases", of_kind(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)),
        F.sha2(listed(plain(F.col("bases"))), 256).alias("base_sha256"),
        listed(F.concat(plain(F.col("bases")), F.col("extra"))).alias("spans"),
        F.size("extra").cast("long").alias("n_added"))
