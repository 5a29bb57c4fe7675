"""Secret scans with multipart credential linking (op 4), in DataFrame functions only.

Base patterns find assignments, access identifiers and long hexadecimal runs.  Weak candidates
(short access identifiers, short or bare secrets, service endpoints) say little alone; they are
reported when complementary parts co-occur: an identifier with a secret, or a secret with an
endpoint, within ``SCOPE`` characters on the same text.

The join of parts is an interval join inside the document's row: the parts, sorted by start,
meet only their neighbours.  Spans of one kind do not overlap and have a minimum length, so
everything within the scope lies among a fixed number of neighbours, and no text is shuffled.

Edge cases: a null or empty text has no spans, the digest of empty text and an empty span list;
equal rows give equal rows; null ids are kept.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelbeam.llm.common import fresh, let, with_struct

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # 18 or more characters in all
HEX = r"[0-9a-f]{16,}"

# Weak parts: reported only when linked.
WEAK_ACCESS = r"""(?i:access_?key_?id|client_?id|key_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{4,}"""
WEAK_SECRET = r"""(?i:client_?key|private_?key|access_?key|passphrase|pwd|auth|credential)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}"""
ENDPOINT = r"""(?i:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp|ssh)://[^\x20\x09-\x0D"'<>]{4,}"""

#: Plain text that every match of a kind holds: texts without it need no regular expression.
NEEDS = {"assign": ("=", ":"), "access": ("AKIA",), "hex": (), "weak_access": ("=", ":"), "weak_secret": ("=", ":"),
         "endpoint": ("://",)}

KINDS = ["assign", "access", "hex", "weak_access", "weak_secret", "endpoint"]
#: What each kind can stand for.
IDENTIFIERS, SECRETS, ENDPOINTS = ["access", "weak_access"], ["assign", "hex", "weak_secret"], ["endpoint"]
SCOPE = 200
#: No kind's match is shorter than this, so within SCOPE characters on one side lie at most
#: SCOPE / MIN_LENGTH + 1 spans of each kind.
MIN_LENGTH = 8
REACH = (SCOPE // MIN_LENGTH + 1) * len(KINDS)


def may_match(text: Column, kind: str) -> Column:
    return reduce(or_, [F.contains(text, F.lit(x)) for x in NEEDS[kind]], F.lit(not NEEDS[kind]))


def matches(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, end, kind), in code points.

    The pieces between the matches give the positions: a match starts after the lengths of
    the pieces and matches before it."""
    order = KINDS.index(kind)
    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    whole = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    # a match's pieces: the text before it (since the last match) and the match itself
    both = F.struct(F.split(text, pattern, -1).alias("gap"), whole.alias("hit"))

    def place(b: Column) -> Column:
        step = lambda acc, i: let(
            acc["at"] + F.length(F.get(b["gap"], i)),
            lambda start: F.struct(
                (start + F.length(F.get(b["hit"], i))).alias("at"),
                F.concat(acc["out"], F.array(F.struct(start.alias("start"), F.lit(order).alias("ord"),
                                                      (start + F.length(F.get(b["hit"], i))).alias("end"),
                                                      F.lit(kind).alias("kind")))).alias("out")))
        zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(b["hit"]) - 1), zero, step, lambda acc: acc["out"])

    return F.when(may_match(text, kind) & F.rlike(text, F.lit(pattern)), let(both, place)).otherwise(none)


def base_spans(text: Column) -> Column:
    long_enough = lambda values: F.filter(
        F.arrays_zip(values["span"], values["value"]), lambda z: F.length(z["value"]) >= 12)
    found = F.struct(matches(text, "assign", ASSIGN).alias("span"),
                     F.when(may_match(text, "assign") & F.rlike(text, F.lit(ASSIGN)),
                            F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
                     .otherwise(F.array().cast("array<string>")).alias("value"))
    assign = let(found, lambda f: F.transform(long_enough(f), lambda z: z["span"]))
    return F.concat(assign, matches(text, "access", ACCESS), matches(text, "hex", HEX))


def weak_spans(text: Column) -> Column:
    return F.concat(matches(text, "weak_access", WEAK_ACCESS), matches(text, "weak_secret", WEAK_SECRET),
                    matches(text, "endpoint", ENDPOINT))


def linked(base: Column, weak: Column) -> Column:
    """The weak spans with a complementary part within SCOPE characters."""

    def near(parts: Column, w: Column, i: Column, kinds: list[str]) -> Column:
        around = F.slice(parts, F.greatest(i - REACH, F.lit(0)) + 1, 2 * REACH + 1)
        return F.exists(around, lambda p: p["kind"].isin(kinds) & (p["start"] <= w["end"] + SCOPE)
                        & (p["end"] >= w["start"] - SCOPE) & ((p["end"] <= w["start"]) | (p["start"] >= w["end"])))

    def keep(parts: Column) -> Column:
        def joins(w: Column, i: Column) -> Column:
            return (F.when(w["kind"] == "weak_access", near(parts, w, i, SECRETS))
                    .when(w["kind"] == "weak_secret", near(parts, w, i, IDENTIFIERS + ENDPOINTS))
                    .when(w["kind"] == "endpoint", near(parts, w, i, SECRETS)).otherwise(False))
        return F.filter(parts, joins)

    return F.when(F.size(weak) > 0, let(F.sort_array(F.concat(base, weak)), keep)).otherwise(weak)


def listing(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(text: Column) -> Column:
    """A struct of base and all spans, each an array of (start, ord, end, kind) sorted by start."""
    t = F.coalesce(text, F.lit(""))
    found = let(t, lambda x: F.struct(base_spans(x).alias("base"), weak_spans(x).alias("weak")))
    return let(found, lambda f: F.struct(
        F.sort_array(f["base"]).alias("base"),
        F.sort_array(F.concat(f["base"], linked(f["base"], f["weak"]))).alias("spans")))


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = with_struct(docs.select("doc_id", "text"), scan(F.col("text")), {"__base": "base", "__spans": "spans"})
    count = lambda kind: F.size(F.filter(F.col("__base"), lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(listing(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
                        listing(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span replaced in the text; columns as given.

    Overlapping spans are replaced once, from the first start to the last end."""
    (spans,) = fresh(docs, "spans")
    text = F.col("text")

    def cut(s: Column) -> Column:
        step = lambda acc, x: F.when(
            x["start"] >= acc["at"],
            F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)).alias("out"),
                     x["end"].alias("at"))).otherwise(
            F.struct(acc["out"].alias("out"), F.greatest(acc["at"], x["end"]).alias("at")))
        zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        return F.aggregate(s, zero, step, lambda acc: F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))

    found = with_struct(docs, scan(text), {spans: "spans"})
    clean = F.when(F.size(F.col(spans)) > 0, cut(F.col(spans))).otherwise(text)
    return found.select(*[(clean if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])
