"""Secret scans by a ledger of blobs.

Every version of every path is content-addressed: equal texts are one blob,
named by its SHA-256. The ledger, a folder of Parquet tables, knows which blob
was scanned with which version of which rule and what was found. A scan reads
only the pairs of a blob and a rule version that the ledger has not seen, adds
them, and joins the findings of all blobs back to all paths that hold them.

A rule's version is a hash of its definition, so a changed rule is scanned anew
and its old findings stay with the old version. Each commit writes its findings
first and its scanned pairs last; findings of a commit without pairs are those
of a job that died, and nobody reads them.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm.common import HOT_SHARE, digest_of, join_spread, slices, table, text_of
from terrafold.sources.filesystem import resolve
from terrafold.workspace import new_path, stored

# Lists of pairs to scan up to this long go to every executor; a longer one is joined.
BROADCAST_PAIRS = 100_000


@dataclass(frozen=True)
class Rule:
    """Leftmost matches that do not overlap; those shorter than ``least`` are dropped.

    ``least`` counts the characters of group ``group``, 0 being the whole match.
    ``hints`` are lower-case strings one of which every match contains, in any
    case; a text without them is not searched.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    hints: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        said = repr((self.kind, self.pattern, self.least, self.group))
        return hashlib.sha256(said.encode()).hexdigest()[:16]


# The base rules, in the order in which spans that begin alike are listed.
BASE = (
    Rule("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]"""
         r"""|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"""
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least=6, group=2,
         hints=("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", "AKIA[A-Z0-9]+", least=20, hints=("akia",)),
    # A run of at least 24; shorter runs cannot hide a longer one, as all are maximal.
    Rule("hex", "[0-9a-f]{24,}", least=24),
)
# What the library adds to them: forms that hardly occur by chance.
ADDED = (
    Rule("pem", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
         hints=("eyj",)),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("login", r"(?:https?|ftps?|ssh|postgres(?:ql)?|mysql|mongodb|rediss?|amqps?)://"
         r"[^\x00-\x20:@/]+:[^\x00-\x20:@/]+@[A-Za-z0-9]", hints=("://",)),
)
RULES = BASE + ADDED

_PAIRS = "array<struct<kind:string,version:string>>"
_SPANS = "array<struct<start:int,end:int>>"
_FINDINGS = f"digest binary, kind string, version string, spans {_SPANS}"


def spans_of(rule: Rule, text: str) -> list[tuple[int, int]]:
    """(start, end) of the rule's matches in code points, the end exclusive."""
    return [m.span() for m in re.finditer(rule.pattern, text)
            if len(m[rule.group]) >= rule.least]


class Ledger:
    """What was scanned and what was found, in a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        system, root = resolve(f"{self.path}/{name}")
        if system.get_file_info(root).type.name != "Directory":
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def pairs(self) -> DataFrame:
        """digest, rules, commit: the rule versions each commit scanned a blob with."""
        return self._read("pairs", f"digest binary, rules {_PAIRS}, commit string")

    def findings(self) -> DataFrame:
        """digest, kind, version, spans of the commits that ended."""
        found = self._read("findings", f"{_FINDINGS}, commit string")
        done = self.pairs().select("commit").distinct()
        return found.join(F.broadcast(done), "commit", "left_semi").drop("commit")

    def commit(self, todo: DataFrame, found: DataFrame) -> None:
        """Add findings, then the pairs they came from."""
        name = uuid.uuid4().hex
        found.write.parquet(f"{self.path}/findings/commit={name}")
        todo.select("digest", "rules").write.parquet(f"{self.path}/pairs/commit={name}")


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``versions``: its other columns, digest, and spans by all ``rules``.

    ``versions`` has ``text`` (null is the empty text) and whatever names the
    paths, their histories and their versions. ``spans`` is an array of (kind,
    start, end) ordered by start, then by the order of the rules; empty where
    nothing was found. Two rules may not share a kind. Repeated rows come out
    repeated, an empty table gives none, other columns of any name stay; there
    must be one at least. Columns named digest or spans are replaced.
    """
    kinds = [r.kind for r in rules]
    if len(set(kinds)) < len(kinds):
        raise ValueError("two rules of one kind")
    others = F.struct(*[F.col(f"`{c}`") for c in versions.columns
                        if c not in ("text", "digest", "spans")])
    paths = stored(versions.select(others.alias("row"), digest_of().alias("digest")), "versions")
    blobs = stored(paths.groupBy("digest").agg(F.count("*").alias("held")), "blobs")
    todo, fresh = _unseen(blobs, ledger, rules)
    if not todo.isEmpty():
        ledger.commit(todo, _searched(versions, blobs, todo, fresh, rules))
    place = F.create_map(*[F.lit(v) for i, r in enumerate(rules) for v in (r.kind, i)])
    wanted = F.create_map(*[F.lit(v) for r in rules for v in (r.kind, r.version)])
    found = (ledger.findings().where(wanted[F.col("kind")] == F.col("version"))
             .dropDuplicates(["digest", "kind"])
             .groupBy("digest").agg(F.flatten(F.collect_list(F.transform("spans", lambda s: F.struct(
                 s.start.alias("start"), place[F.col("kind")].alias("place"),
                 F.col("kind").alias("kind"), s.end.alias("end"))))).alias("spans")))
    spans = F.transform(F.array_sort("spans"), lambda s: F.struct(
        s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    held = stored(blobs.join(found.select("digest", spans.alias("spans")), "digest"), "found")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return (join_spread(paths, held, "digest", "held")
            .select("row.*", "digest", F.coalesce("spans", none).alias("spans")))


def _unseen(blobs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...]) -> tuple[DataFrame, bool]:
    """digest, rules: the rule versions the ledger lacks for a blob; and whether that is all of all."""
    all_rules = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"))
                          for r in rules])
    pairs = ledger.pairs().drop("commit")
    if pairs.isEmpty():
        return blobs.select("digest", all_rules.alias("rules")), True
    seen = pairs.groupBy("digest").agg(F.flatten(F.collect_list("rules")).alias("seen"))
    left = blobs.join(seen, "digest", "left").select("digest", F.coalesce(
        F.array_except(all_rules, "seen"), all_rules).alias("rules"))
    return stored(left.where(F.size("rules") > 0), "unseen"), False


def _searched(versions: DataFrame, blobs: DataFrame, todo: DataFrame, fresh: bool,
              rules: tuple[Rule, ...]) -> DataFrame:
    """Findings in the blobs of ``todo``, each blob searched where its text meets.

    Texts are dealt by digest, and a task passes over what it has seen. A blob
    that many rows hold is first reduced to one text a task.
    """
    texts = versions.select(digest_of().alias("digest"), text_of().alias("text"))
    if not fresh:
        few = todo.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS
        texts = texts.join(F.broadcast(todo) if few else todo, "digest")
    else:
        texts = texts.withColumn("rules", F.lit(None).cast(_PAIRS))
    total = blobs.agg(F.sum("held")).first()[0] or 0
    hot = stored(blobs.where(F.col("held") * HOT_SHARE > total).select("digest"), "hot")
    cold = texts.join(F.broadcast(hot), "digest", "left_anti").repartition("digest")
    found = cold.mapInArrow(_searcher(rules), _FINDINGS)
    if hot.isEmpty():
        return found
    one = (texts.join(F.broadcast(hot), "digest", "left_semi")
           .groupBy("digest").agg(F.first("text").alias("text"), F.first("rules").alias("rules")))
    return found.unionByName(one.mapInArrow(_searcher(rules), _FINDINGS))


def _searcher(rules: tuple[Rule, ...]):
    """Search batches of (digest, text, rules); null rules are all of them."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        known = {(r.kind, r.version): r for r in rules}
        for batch in batches:
            digests, texts, wanted = (batch.column(batch.schema.get_field_index(c))
                                      for c in ("digest", "text", "rules"))
            for a, b in slices(texts):
                out = []
                for digest, text, some in zip(digests[a:b].to_pylist(), texts[a:b].to_pylist(),
                                              wanted[a:b].to_pylist()):
                    if digest in seen:
                        continue
                    seen.add(digest)
                    lower = text.lower()
                    for rule in rules if some is None else [
                            known[r["kind"], r["version"]] for r in some]:
                        if rule.hints and not any(h in lower for h in rule.hints):
                            continue
                        if spans := spans_of(rule, text):
                            out.append((digest, rule.kind, rule.version,
                                        [{"start": x, "end": y} for x, y in spans]))
                if out:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(column, kind) for column, kind in zip(zip(*out), (
                            pa.binary(), pa.string(), pa.string(), pa.list_(pa.struct(
                                [("start", pa.int32()), ("end", pa.int32())]))))],
                        names=["digest", "kind", "version", "spans"])

    return search


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op11_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The spans of every document, the counts and the digest of the base ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, Ledger(spark, new_path(spark, "ledger")))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    counts = [F.size(of(r.kind)).cast("bigint").alias(f"n_{r.kind}") for r in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(listed(of(*[r.kind for r in BASE])), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _sql_spans(rule: Rule) -> str:
    """The spans of one rule in SQL: lengths of matches and of what lies between them."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, text, '{rule.kind}' AS kind, {RULES.index(rule)} AS place,
         regexp_extract_all(text, '{pattern}', {rule.group}) AS said,
         regexp_extract_all(text, '{pattern}') AS found,
         string_split_regex(text, '{pattern}') AS rest FROM docs"""


OP11_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS (""" + "\n  UNION ALL".join(_sql_spans(r) for r in RULES) + r"""),
placed AS (
  SELECT doc_id, kind, place, length(said[i]) AS n,
         (list_sum([length(x) for x in rest[1:i]])
          + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0))::BIGINT AS start,
         length(found[i]) AS size
  FROM matches, range(1, len(found) + 1) r(i) WHERE len(found) > 0),
kept AS (
  SELECT doc_id, kind, place, start, kind || ':' || start || ':' || (start + size) AS span
  FROM placed WHERE n >= CASE kind """ + " ".join(
    f"WHEN '{r.kind}' THEN {r.least}" for r in RULES) + r""" END),
lists AS (
  SELECT doc_id,
         count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, place)
           FILTER (kind IN ('assign', 'access', 'hex')) AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans
  FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (doc_id)
"""
