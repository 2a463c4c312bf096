"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is a blob, addressed by its SHA-256. The ledger holds one row for each (blob, rule version) that
was ever scanned, with the spans found, empty ones included. A scan reads only pairs that the ledger lacks, appends
them, and joins the spans back to every path that carries the blob, so copies and later runs cost a hash each.

Edge cases: a null text is an empty text; empty tables give empty results; rows with the same id or text each keep a row;
a null id is a path like any other; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itinera.llm.common import map_rows, text_rows
from itinera.session import scratch_path

#: Rule version, part of the ledger's key: raise it when a rule changes.
RULES = "2"
BASE = ("assign", "access", "hex")
SPAN = "array<struct<kind:string,start:int,end:int>>"

# The three base rules; each a pattern, the group whose length counts, and its least length.
_BASE_RULES = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),  # runs are maximal, so the length may stand in the pattern
}
_MORE_RULES = {
    "pem": (re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"), 0, 0),
    "forge": (re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 0),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"), 0, 0),
}
_RULES = _BASE_RULES | _MORE_RULES
# A text without any of these substrings cannot match the rule (for assign, of the lower-cased text).
_NEEDLES = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "pem": ("PRIVATE KEY",),
    "forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "jwt": ("eyJ",),
}
_ORDER = {k: i for i, k in enumerate(_RULES)}


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    out = []
    for kind, (pattern, group, least) in _RULES.items():
        needles = _NEEDLES.get(kind)
        if needles:
            where = text.lower() if kind == "assign" else text
            if not any(x in where for x in needles):
                continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end()))
    out.sort(key=lambda s: (s[1], _ORDER[s[0]]))
    return out


def _address(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _blobs_of_task(batches):
    """Each distinct text of a task once: the combine before the shuffle."""
    seen = set()
    for batch in batches:
        blobs, texts = [], []
        for text in batch["text"]:
            text = text or ""
            blob = _address(text)
            if blob not in seen:
                seen.add(blob)
                blobs.append(blob)
                texts.append(text)
        yield blobs, texts


def _scan(batches):
    """Blobs arrive in order, so copies that different tasks sent are neighbours."""
    last = None
    for batch in batches:
        blobs, spans = [], []
        for blob, text in zip(batch["blob"], batch["text"], strict=True):
            if blob != last:
                last = blob
                blobs.append(blob)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in find_spans(text)])
        yield blobs, [RULES] * len(blobs), spans


def read_ledger(spark, ledger: str) -> DataFrame:
    schema = f"blob string, rules string, spans {SPAN}"
    return spark.read.schema(schema).parquet(ledger)


def update_ledger(versions: DataFrame, ledger: str, first: bool = False) -> None:
    """Scan the texts whose (blob, rule version) the ledger lacks and append them; a repeated run appends nothing.

    ``first``: the ledger does not exist yet. One run at a time may append to a ledger.
    """
    blobs = map_rows(text_rows(versions).select("text"), _blobs_of_task, "blob string, text string")
    if not first:
        known = read_ledger(versions.sparkSession, ledger).where(F.col("rules") == RULES).select("blob").distinct()
        blobs = blobs.join(known, "blob", "left_anti")
    parts = max(2, int(versions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = blobs.repartition(parts, "blob").sortWithinPartitions("blob")
    map_rows(ordered, _scan, f"blob string, rules string, spans {SPAN}").write.mode("append").parquet(ledger)


def _blob_of(column: str):
    return F.sha2(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"), 256).alias("blob")


def _hits(versions: DataFrame, ledger: str | None) -> DataFrame:
    """(blob, spans) of the blobs with findings, once the ledger knows all versions. The ledger holds a pair only once, so
    the join that follows needs no aggregate and a hot blob's paths can be split by adaptive execution."""
    spark = versions.sparkSession
    path = ledger or scratch_path(spark, "ledger")
    update_ledger(versions, path, ledger is None)
    return read_ledger(spark, path).where((F.col("rules") == RULES) & (F.size("spans") > 0)).select("blob", "spans")


def scan_secrets(versions: DataFrame, ledger: str | None = None) -> DataFrame:
    """(doc_id, blob, spans) for every row of (doc_id, text), through the ledger at the given path (default: a new one)."""
    hits = _hits(versions, ledger)
    paths = text_rows(versions).select("doc_id", _blob_of("text"))
    return paths.join(hits, "blob", "left").select("doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def mask_secrets(docs: DataFrame, mark: str = "[REDACTED]", ledger: str | None = None) -> DataFrame:
    """The same rows and columns with every span of the text replaced by ``mark``; rows without spans stay as they are."""
    keyed = docs.select(F.struct("*").alias("row"), _blob_of("text"))
    masked = F.udf(lambda text, found: _masked(text, found, mark), "string")
    joined = keyed.join(_hits(docs, ledger), "blob", "left")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(masked("row.text", "spans"))
    return joined.select(*[(text if n == "text" else F.col(f"row.`{n}`")).alias(n) for n in docs.columns])


def _masked(text, found, mark):
    if not text or not found:
        return text
    out, at = [], 0
    for start, end in sorted((s["start"], s["end"]) for s in found):
        if end > at:
            out.append(text[at : max(at, start)])
            if start >= at:
                out.append(mark)
            at = end
    return "".join(out) + text[at:]


def op7(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
