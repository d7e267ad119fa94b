"""A content-addressed WARC archive.

Two tables make the archive: ``payloads`` holds the bytes of every different
payload once, filed under its SHA-256, and ``headers`` holds the exact header of
every record. A record is its header, and for responses the payload the header's
table names; the join of the two gives the original records back, byte by byte.
Records with a payload filed already are revisits and name the response.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm.common import join_spread, table, text_of
from terrafold.workspace import new_path, stored

# Payloads of fewer bytes are always responses.
LEAST_BYTES = 0
DATE = "2000-01-01T00:00:00Z"
# The digits of base32, and the profile of revisits with identical payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of bytes as 32 upper-case base32 digits."""
    text = F.sha1(payload)
    digits = []
    for i in range(0, 40, 5):  # 5 hex digits are 20 bits, 4 base32 digits
        value = F.conv(F.substring(text, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digits.append(F.substring(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(31) + 1,
                                      F.lit(1)))
    return F.concat(*digits)


def _safe(url: Column) -> Column:
    """A header holds one line: characters that end or break one are percent-encoded."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(
        url, "\r", "%0D"), "\n", "%0A"), " ", "%20")


def record_id(page: Column) -> Column:
    """A URN made of the page's id, so that writing again names records alike."""
    h = F.md5(F.concat(F.lit("page "), F.coalesce(page.cast("string"), F.lit("null"))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), *[part for a, n, dash in (
        (1, 8, "-"), (9, 4, "-"), (13, 4, "-"), (17, 4, "-"), (21, 12, ">"))
        for part in (F.substring(h, a, n), F.lit(dash))])


def write_archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES,
                  date: str = DATE) -> None:
    """Write ``pages`` (page_id, url, html) as an archive to ``path``.

    The payload is html in UTF-8, null being empty. Of records with equal
    payloads that with the largest page_id is the response (a null page_id is
    the smallest), the others are revisits; payloads below ``least_bytes`` are
    all responses. Of repeated rows of the largest page_id one is the response.
    """
    payload = text_of("html").cast("binary")
    rows = stored(pages.select("page_id", "url", F.unhex(F.sha2(payload, 256)).alias("key"),
                               base32_sha1(payload).alias("digest"),
                               F.octet_length(payload).cast("bigint").alias("bytes")), "rows")
    groups = stored(rows.groupBy("key").agg(F.max("page_id").alias("first"),
                                            F.count("*").alias("n")), "groups")
    # A row is told apart from rows alike by the order of their urls only where there are any.
    units = rows.groupBy("key", "page_id").agg(F.count("*").alias("n"), F.min(
        F.xxhash64("url")).alias("least_url"), F.count_distinct(F.xxhash64("url")).alias("urls"))
    told = join_spread(rows, groups, "key", "n", "inner")
    revisit = (F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    again = stored(units.where(F.col("n") > 1).select(
        "key", F.col("page_id").alias("__page"), "least_url"), "again")
    if not again.isEmpty():
        told = _one_response(told, again, least_bytes)
    else:
        told = told.withColumn("copy", F.lit(0))
    revisit = revisit | ((F.col("bytes") >= least_bytes) & (F.col("copy") > 0))
    told = told.withColumn("revisit", revisit)
    size = F.when(F.col("revisit"), F.lit(0).cast("bigint")).otherwise(F.col("bytes"))
    name = F.when(F.col("copy") > 0, F.concat_ws("#", F.coalesce(F.col("page_id").cast(
        "string"), F.lit("null")), F.col("copy").cast("string")))
    own_id = record_id(F.coalesce(name, F.col("page_id").cast("string")))
    lines = [F.lit("WARC/1.1"),
             F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit")
                      .otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: "), own_id),
             F.lit(f"WARC-Date: {date}"),
             F.concat(F.lit("WARC-Target-URI: "), _safe(F.col("url"))),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
             F.concat(F.lit("X-Page-ID: "), F.col("page_id").cast("string")),
             F.when(F.col("revisit"), F.lit(f"WARC-Profile: {PROFILE}")),
             F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "),
                                               record_id(F.col("first").cast("string")))),
             F.when(F.col("revisit"), F.concat(F.lit("X-Refers-To-Page: "),
                                               F.col("first").cast("string"))),
             F.lit("Content-Type: text/html; charset=utf-8"),
             F.concat(F.lit("Content-Length: "), size.cast("string"))]
    # concat_ws leaves out the lines that are null.
    header = F.concat(F.concat_ws(END, *lines), F.lit(END + END))
    told.select(header.cast("binary").alias("header"), "key", "revisit") \
        .write.option("compression", "zstd").parquet(f"{path}/headers")

    # Each payload is taken from its response's row; only texts that stay are moved.
    chosen = groups.select("key", F.coalesce(F.col("first").cast("string"), F.lit("null"))
                           .alias("id"))
    texts = pages.select(F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("id"),
                         F.unhex(F.sha2(payload, 256)).alias("key"), payload.alias("payload"))
    found = texts.join(chosen, ["id", "key"], "left_semi")
    if not again.isEmpty():
        found = found.dropDuplicates(["key"])
    found.select("key", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")


def _one_response(told: DataFrame, again: DataFrame, least_bytes: int) -> DataFrame:
    """Number the rows that share payload and page_id, 0 for the first by url."""
    same = (told["key"] == again["key"]) & told["page_id"].eqNullSafe(again["__page"])
    rest = told.join(again, same, "left_anti").withColumn("copy", F.lit(0))
    # Rows alike in all columns are counted, not listed, until their numbers are given.
    alike = (told.join(again, same, "left_semi")
             .groupBy(*told.columns).agg(F.count("*").alias("__n")))
    from pyspark.sql import Window

    before = F.sum("__n").over(Window.partitionBy("key", "page_id").orderBy(
        F.col("url").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    numbered = (alike.withColumn("__before", F.coalesce(before, F.lit(0)))
                .withColumn("copy", F.explode(F.sequence(
                    F.col("__before"), F.col("__before") + F.col("__n") - 1)))
                .withColumn("copy", F.when(F.col("bytes") < least_bytes, 0)
                            .otherwise(F.col("copy")).cast("int")))
    return rest.unionByName(numbered.select(*rest.columns))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """record, the exact bytes of every record: header, block, two line ends.

    The block of a response is joined from the payloads, after its digest was
    computed again and found to be its key; revisits have no block.
    """
    ends = F.lit(END + END).cast("binary")
    headers = spark.read.parquet(f"{path}/headers")
    same = F.unhex(F.sha2(F.col("payload"), 256)) == F.col("key")
    payloads = spark.read.parquet(f"{path}/payloads").select("key", F.when(
        same, F.col("payload")).otherwise(F.raise_error(F.lit("a payload does not fit its digest"))
                                          .cast("binary")).alias("payload"))
    whole = (headers.where(~F.col("revisit")).join(payloads, "key")
             .select(F.concat("header", "payload", ends).alias("record")))
    bare = headers.where("revisit").select(F.concat("header", ends).alias("record"))
    return whole.unionByName(bare)


def parsed(records: DataFrame) -> DataFrame:
    """type, page_id, refers_page, url, digest, block of WARC records, from their bytes."""
    # Bytes as Latin-1 text, one character a byte: places found in it are places in the bytes.
    as_text = F.decode(F.col("record"), "ISO-8859-1")
    cut = records.select("record", F.instr(as_text, END + END).alias("__at"))
    head = cut.select("record", "__at", F.decode(F.expr("substring(record, 1, __at + 1)"),
                                                 "UTF-8").alias("__head"))

    def field(name: str) -> Column:
        found = F.regexp_extract("__head", f"\r\n{name}: ([^\r]*)\r\n", 1)
        return F.when(found != "", found)

    rows = head.select("record", "__at", field("WARC-Type").alias("type"),
                       field("X-Page-ID").cast("bigint").alias("page_id"),
                       field("X-Refers-To-Page").cast("bigint").alias("refers_page"),
                       field("WARC-Target-URI").alias("url"),
                       F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("digest"),
                       field("Content-Length").cast("int").alias("__length"))
    block = F.expr("substring(record, __at + 4, __length)")
    whole = F.octet_length("record") == F.col("__at") + 7 + F.col("__length")
    return rows.select("type", "page_id", "refers_page", "url", "digest", F.when(
        whole, block).otherwise(F.raise_error(F.lit("a record's length is wrong"))
                                .cast("binary")).alias("block"))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back."""
    path = new_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    read = parsed(read_records(spark, path))
    rows = stored(read.select("page_id", "type", "refers_page", "digest",
                              F.octet_length("block").cast("bigint").alias("bytes"),
                              base32_sha1(F.col("block")).alias("own")), "read")
    # A response's digest is that of the bytes read; a revisit's full payload is the response's.
    responses = rows.where(F.col("type") == "response")
    sizes = stored(responses.groupBy("own").agg(F.max("bytes").alias("full")), "sizes")
    named = stored(rows.select("page_id", "type", "refers_page", F.when(
        F.col("type") == "response", F.col("own")).otherwise(F.col("digest")).alias("own")), "named")
    weights = named.groupBy("own").agg(F.count("*").alias("n"))
    full = join_spread(named, stored(sizes.join(weights, "own"), "weights"), "own", "n", "left")
    return full.select("page_id", F.col("full").alias("payload_bytes"),
                       F.col("own").alias("payload_digest"), F.col("type").alias("record_type"),
                       F.col("refers_page").alias("refers_to"))


_SQL_DIGITS = " || ".join(
    f"substr('{BASE32}', (((('0x' || substr(h, {i + 1}, 5))::bigint >> {shift}) & 31) + 1)::bigint, 1)"
    for i in range(0, 40, 5) for shift in (15, 10, 5, 0))

OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p GROUP BY html),
d AS (SELECT html, first, sha1(html) AS h FROM g)
SELECT page_id, strlen(html)::bigint AS payload_bytes, {_SQL_DIGITS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN d USING (html)
"""
