"""Secret scans by dictionary-primed zstandard novelty.

Three base patterns always report. Besides, in a sensitive context (a word such as ``key`` or ``bearer`` shortly
before) every long unbroken string is a candidate: it is compressed with a raw dictionary made of common identifiers
and the text around it, and reported as ``novel`` when its marginal compressed bytes show that hardly any of it can be
copied from there. Identifiers, words of the text and repeated strings compress; random keys do not. Only what matches
save counts: zstandard also entropy-codes 64 or more literals, which would make a long random key of a small alphabet
look copied, so a string is compressed in pieces below that, each after what precedes it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import texts_of, unused_name

# The base patterns, in the order in which kinds are listed.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

# Words that make a context sensitive.
SENSITIVE = (
    "access_key", "api_key", "apikey", "auth", "bearer", "client_secret", "cookie", "credential", "passphrase",
    "passwd", "password", "private_key", "pwd", "secret", "session_id", "signature", "token",
)
_SENSITIVE = re.compile("|".join(SENSITIVE), re.I | re.A)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

# Identifiers of common code, the shared part of every dictionary.
IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000 1111111111 xxxxxxxxxxxxxxxx XXXXXXXX "
    "example changeme placeholder your_api_key_here insert_token_here replace_me dummy sample default undefined null "
    "access_key access_token api_key api_token application authentication authorization Authorization: Bearer base64 "
    "boolean buffer callback certificate client_id client_secret configuration connection_string const container "
    "content-type context controller credentials database decode decrypt default_value description development "
    "directory document element encode encrypt endpoint environment exception expires_in export factory filename "
    "function generate_token get_secret get_session getAccessToken getPassword getToken handler header https://www. "
    "identifier implementation import index initialize instance interface javascript language length library listener "
    "localhost manager message method middleware module namespace number object option org.apache.spark.sql override "
    "package parameter parse_token password password_hash path pattern permission private_key production property "
    "protected provider public_key public static void query refresh_token register repository request require_auth "
    "resource response return secret_key secretsmanager select self.session server service session_id session_token "
    "setPassword settings signature source state static status storage string struct subscription superclass synchronized "
    "template test_user timeout token_endpoint transaction typeof undefined update upload url username utf-8 validate_token "
    "value variable version webhook window workspace aws_access_key_id aws_secret_access_key "
).encode()

#: Code points between a sensitive word and its candidate, code points of text on each side that prime the
#: dictionary, and the least share of marginal bytes per byte of a reported string.
REACH = 48
AROUND = 4096
LEAST_NOVELTY = 0.85
#: Bytes of a string that are compressed at once: zstandard leaves fewer than 64 literals as they are.
PIECE = 63


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def base_spans(text: str) -> list[Span]:
    """The matches of the three base patterns, by start and then kind; places are code points, ends exclusive."""
    low = text.lower()
    found = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [Span(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [Span(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def novelty(candidate: str, before: str, after: str, identifiers: bytes = IDENTIFIERS) -> float:
    """Marginal compressed bytes per byte of ``candidate``, given identifiers and the text on both sides of it."""
    raw, size = candidate.encode(), 0
    around, near = identifiers + after.encode(), before.encode()
    for at in range(0, len(raw), PIECE):
        primed = around + near + raw[max(0, at - AROUND) : at]  # what is nearest comes last: the cheapest to copy from
        packer = zstandard.ZstdCompressor(
            level=6, dict_data=zstandard.ZstdCompressionDict(primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False
        )
        size += len(packer.compress(raw[at : at + PIECE])) - len(packer.compress(b""))
    return size / len(raw)


def novel_spans(text: str, known: list[Span], identifiers: bytes = IDENTIFIERS, least: float = LEAST_NOVELTY) -> Iterator[Span]:
    """Incompressible strings after sensitive words that no known span touches."""
    at = 0
    for word in _SENSITIVE.finditer(text):
        for m in _CANDIDATE.finditer(text, max(at, word.end()), len(text)):
            if m.start() > word.end() + REACH or "\n" in text[word.end() : m.start()]:
                break
            at = m.end()
            if any(s.start < m.end() and m.start() < s.end for s in known):
                continue
            before, after = text[max(0, m.start() - AROUND) : m.start()], text[m.end() : m.end() + AROUND]
            if novelty(m[0], before, after, identifiers) >= least:
                yield Span(m.start(), 3, m.end())


def spans(text: str, identifiers: bytes = IDENTIFIERS, least: float = LEAST_NOVELTY) -> list[Span]:
    """All spans of a whole text, by start and then kind."""
    base = base_spans(text)
    low = text.lower()
    if any(w in low for w in SENSITIVE):
        base = sorted(base + list(novel_spans(text, base, identifiers, least)))
    return base


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def _span_column(texts: pa.Array) -> pa.Array:
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    return pa.array([[{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in spans(t.as_py())] for t in texts], pa.list_(item))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``, one row per input row; a span is its kind, start and end (exclusive) in code points.

    A null or empty text has no span; a null id stays null; repeated rows stay; an empty table gives no rows; other
    columns are ignored. Spans of different kinds may overlap; a novel one overlaps no other.
    """

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _span_column(b.column(1))], ["doc_id", "spans"])

    return texts_of(docs).mapInArrow(run, f"doc_id long, spans {_SPANS}")


def redact(text: str, mark: str = "[REDACTED]") -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for s in spans(text):
        if s.start >= at:
            out += [text[at : s.start], mark]
        at = max(at, s.end)
    return "".join([*out, text[at:]]) if out else text


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` counted anew where a text changed.

    All rows, columns and their order stay; null texts stay null; ``n_chars`` is only touched if it is there.
    """

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(redact, na_action="ignore")

    new = unused_name(docs)
    out = docs.withColumn(new, clean(F.col("text").cast("string")))
    changed = F.col(new).isNotNull() & (F.col(new) != F.col("text"))
    columns = {
        "text": F.col(new).alias("text"),
        "n_chars": F.when(changed, F.char_length(new)).otherwise(F.col("n_chars")).cast(dict(docs.dtypes).get("n_chars", "long")).alias("n_chars"),
    }
    return out.select(*[columns[c] if c in columns else F.col(f"`{c}`") for c in docs.columns])


def joined(found: str, kinds: tuple[str, ...]) -> F.Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined."""
    kept = F.filter(F.col(found), lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
