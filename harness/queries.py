"""Every operator as a query over the given tables, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.functions import checksums, exchange, naming, rdf
from covenant.functions import headers as hdr
from covenant.functions import text as txt
from covenant.functions.labels import parse_label
from covenant.operators import counts, federation, feeds, files, grants, messages, snapshots, versions
from covenant.operators import rdf as rdf_ops
from covenant.operators.joins import shuffled_join
from covenant.operators.rules import federate_classes
from covenant.plans.inbound import Landing, land_files
from covenant.plans.outbound import outbound_files as outbound_file_plan
from covenant.plans.outbound import outbound_messages
from covenant.session import scratch_path, written
from covenant.sinks.exchange import DEAD_LETTER, DELIVERED, read_exchange
from covenant.sinks.files import write_files
from covenant.sinks.messages import for_target
from covenant.sources import messages as message_source
from covenant.sources.documents import read_feeds_config
from covenant.sources.objects import read_files, stat_files
from covenant.streaming import federation as streams
from covenant.streaming.intake import Intake, intake_writer
from covenant.streaming.progress import DeliveredTable, ProgressTable, merge_progress
from covenant.streaming.refresh import Refreshed, VersionedTable
from harness import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def text_pairs(pairs: Column) -> Column:
    """``KEY=value`` texts of a list of pairs, joined in alphabetical order."""
    first, second = ("key", "value")
    return F.array_join(F.array_sort(F.transform(pairs, lambda p: F.concat_ws("=", p[first], p[second]))), ",")


# --- SQL of the inputs -------------------------------------------------------------------------------------------

_LABEL = """CASE WHEN d.doc_id % 50 = 0 THEN 'A=' WHEN d.doc_id % 31 = 0 THEN '   '
    ELSE ' nationality : ' || lang || coalesce(',clearance=' || l.quality, '')
      || CASE WHEN d.doc_id % 13 = 0 THEN ',organisation_type=gov' ELSE '' END END"""

MESSAGES = f"""messages AS (
  SELECT d.source AS topic, d.doc_id AS pos, d.text, d.lang, l.quality,
    {_LABEL} AS label,
    d.doc_id % 50 = 0 AS bad,
    d.doc_id % 50 <> 0 AND d.doc_id % 31 = 0 AS blank
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

# One row per label entry; blank and malformed labels have none.
ENTRIES = f"""{MESSAGES},
entries AS (
  SELECT pos, 'NATIONALITY' AS k, upper(lang) AS v FROM messages WHERE NOT bad AND NOT blank
  UNION ALL SELECT pos, 'CLEARANCE', quality::VARCHAR FROM messages WHERE NOT bad AND NOT blank AND quality IS NOT NULL
  UNION ALL SELECT pos, 'ORGANISATION_TYPE', 'GOV' FROM messages WHERE NOT bad AND NOT blank AND pos % 13 = 0)"""


def _sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _policy(rows: list) -> str:
    flat = []
    for number, (product, topic, consumer, attributes) in enumerate(rows):
        for place, (name, value) in enumerate(attributes or [(None, None)]):
            flat.append(
                f"({number * 10 + place}, {_sql(product)}, {_sql(topic)}, {_sql(consumer)}, "
                f"{'true' if attributes else 'false'}, {_sql(name)}, {_sql(value)})"
            )
    return (
        "policy(place, product, topic, consumer, has_attribute, name, value) AS (VALUES " + ", ".join(flat) + "), "
        "access AS (SELECT DISTINCT consumer, lower(topic) AS tk FROM policy), "
        "rules AS (SELECT a.consumer, a.tk, p.name, p.value, min(p.place) AS place FROM access a JOIN policy p "
        "ON p.consumer = a.consumer AND p.has_attribute AND (lower(p.topic) = a.tk OR lower(p.product) = a.tk) "
        "GROUP BY ALL)"
    )


_JUDGED = """judged AS (
  SELECT a.consumer, m.pos, m.topic, r.place,
    CASE WHEN r.place IS NULL THEN NULL
         WHEN m.bad THEN 'BAD_LABEL'
         WHEN r.name IS NULL OR r.value IS NULL THEN 'INVALID_FILTER'
         WHEN e.v IS NULL THEN 'MISSING_ATTRIBUTE'
         WHEN e.v <> upper(r.value) THEN 'VALUE_MISMATCH' END AS reason
  FROM messages m JOIN access a ON a.tk = lower(m.topic)
  LEFT JOIN rules r ON r.consumer = a.consumer AND r.tk = a.tk
  LEFT JOIN entries e ON e.pos = m.pos AND e.k = upper(r.name)),
decisions AS (
  SELECT consumer, pos, topic, arg_min(reason, place) FILTER (WHERE reason IS NOT NULL) AS reason
  FROM judged GROUP BY consumer, pos, topic)"""

DECISIONS = f"WITH {ENTRIES}, {_policy(views.POLICY)}, {_JUDGED}"


# --- messages ----------------------------------------------------------------------------------------------------


@query(f"""WITH {MESSAGES} SELECT pos AS "offset", label AS first_label, 1 + (pos % 11 = 0)::INT AS labels,
  CASE WHEN pos % 11 = 0 THEN 'nationality=zz' ELSE label END AS last_label, '' AS absent_first,
  NULL::VARCHAR AS absent_last FROM messages""")
def header_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("headers")
    return views.messages(spark, sf_dir).select(
        "offset",
        hdr.header_first(h, "SECURITY-label").alias("first_label"),
        F.size(hdr.header_all(h, "Security-Label")).alias("labels"),
        hdr.header_last(h, "Security-Label").alias("last_label"),
        hdr.header_first(h, "Request-ID").alias("absent_first"),
        hdr.header_last(h, "Request-ID").alias("absent_last"),
    )


@query(f"""WITH {MESSAGES} SELECT pos AS "offset", concat_ws('|', 'Content-Type=text/plain',
  CASE WHEN pos % 10 = 0 THEN 'Content-Type=application/n-triples' END,
  CASE WHEN pos % 14 = 0 THEN 'Content-Type=Application/RDF-Patch' END,
  CASE WHEN pos % 5 = 0 THEN 'orgName= org-' || lang || ' ' END) AS kept FROM messages""")
def select_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = hdr.select_headers(F.col("headers"), hdr.shared_header_names("Content-Type^orgName"))
    texts = F.transform(kept, lambda h: F.concat_ws("=", h["key"], h["value"]))
    return views.messages(spark, sf_dir).select("offset", F.array_join(texts, "|").alias("kept"))


@query(f"""WITH {ENTRIES} SELECT m.pos AS "offset", m.bad AS malformed,
  coalesce(string_agg(e.k || '=' || e.v, ',' ORDER BY e.k), '') AS entries
  FROM messages m LEFT JOIN entries e ON e.pos = m.pos GROUP BY m.pos, m.bad""")
def label_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = parse_label(hdr.header_first(F.col("headers"), hdr.SECURITY_LABEL))
    return (
        views.messages(spark, sf_dir)
        .select("offset", label.alias("label"))
        .select("offset", F.col("label.malformed").alias("malformed"), text_pairs(F.col("label.entries")).alias("entries"))
    )


@query(r"""WITH parts AS (SELECT doc_id, unnest(string_split(text, ',')) AS part, unnest(range(len(string_split(text, ',')))) AS n
    FROM documents),
  cleaned AS (SELECT doc_id, n, regexp_replace(part, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS part FROM parts),
  cut AS (SELECT doc_id, n, part, least(nullif(strpos(part, '='), 0), nullif(strpos(part, ':'), 0)) AS c FROM cleaned WHERE part <> ''),
  pairs AS (SELECT doc_id, n, upper(regexp_replace(substr(part, 1, c - 1), '[\x00-\x20]+$', '')) AS k,
    upper(regexp_replace(substr(part, c + 1), '^[\x00-\x20]+', '')) AS v FROM cut),
  judged AS (SELECT doc_id, bool_or(coalesce(k, '') = '' OR coalesce(v, '') = '') AS malformed FROM pairs GROUP BY doc_id),
  last AS (SELECT doc_id, k, arg_max(v, n) AS v FROM pairs GROUP BY doc_id, k),
  listed AS (SELECT doc_id, string_agg(k || '=' || v, ',' ORDER BY k || '=' || v) AS entries FROM last GROUP BY doc_id)
  SELECT d.doc_id, coalesce(malformed, false) AS malformed, CASE WHEN malformed THEN '' ELSE coalesce(entries, '') END AS entries
  FROM documents d LEFT JOIN judged j ON j.doc_id = d.doc_id LEFT JOIN listed l ON l.doc_id = d.doc_id""")
def label_parsing_of_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = parse_label(F.col("text"))
    return views.table(spark, sf_dir, "documents").select("doc_id", label.alias("label")).select(
        "doc_id", F.col("label.malformed").alias("malformed"), text_pairs(F.col("label.entries")).alias("entries")
    )


@query("""SELECT o_orderkey, 'A=' || upper(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE o_orderstatus END)
  || ',K==' || upper(o_orderstatus) AS entries FROM orders""")
def label_last_of_repeated_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit(",a:"), "o_orderpriority")).otherwise("")
    text = F.concat(F.lit("a="), "o_orderstatus", F.lit(", ,k:="), "o_orderstatus", tail)
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", text_pairs(parse_label(text)["entries"]).alias("entries")
    )


@query(f"""WITH {MESSAGES} SELECT pos AS "offset", CASE WHEN pos % 7 = 0 THEN 'Missing Key - ' || pos || ' ' || topic
  ELSE 'k' || pos END AS key FROM messages""")
def default_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = messages.default_key(F.col("key"), F.col("offset"), F.col("topic"))
    return views.messages(spark, sf_dir).select("offset", F.decode(key, "UTF-8").alias("key"))


@query("SELECT doc_id, sha256(text) AS checksum FROM documents")
def payload_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", checksums.payload_checksum(F.encode("text", "UTF-8")).alias("checksum"))


@query(f"""WITH {MESSAGES} SELECT topic, pos AS "offset",
  CASE WHEN pos % 7 = 0 THEN 'Missing Key - ' || pos || ' ' || topic ELSE 'k' || pos END AS key,
  1 + (pos % 10 = 0)::INT + (pos % 14 = 0)::INT AS headers, text AS value,
  sha256(text) AS payload_checksum, 'SHA-256' AS checksum_algorithm FROM messages""")
def to_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = messages.to_envelope(views.messages(spark, sf_dir))
    return shaped.select(
        "topic",
        "offset",
        F.decode("key", "UTF-8").alias("key"),
        F.size("headers").alias("headers"),
        F.decode("value", "UTF-8").alias("value"),
        "payload_checksum",
        "checksum_algorithm",
    )


@query(f"""WITH {MESSAGES} SELECT pos AS "offset", CASE WHEN pos % 14 = 0 THEN 'patch' ELSE 'dataset' END AS kind,
  CASE WHEN pos % 14 = 0 THEN 'Application/RDF-Patch' WHEN pos % 10 = 0 THEN 'application/n-triples'
  ELSE 'text/plain' END AS content_type FROM messages""")
def payload_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.col("headers")
    return views.messages(spark, sf_dir).select(
        "offset", rdf.payload_kind(h).alias("kind"), rdf.content_type(h).alias("content_type")
    )


_RDF = """rdf AS (
  SELECT c_custkey AS k, '<http://example.org/c/' || c_custkey || '>' AS s, '"' || c_name || '"' AS n,
    '<http://example.org/n/' || c_nationkey || '>' AS o, c_mktsegment AS topic,
    CASE WHEN c_custkey % 7 = 0 THEN '<http://example.org/g>' END AS g,
    c_custkey % 10 <> 0 AND NOT (c_custkey % 14 = 0) AND NOT (c_custkey % 11 = 0) AS ok
  FROM customer),
quads AS (
  SELECT k, topic, s AS subject, '<http://example.org/name>' AS predicate, n AS object, g AS graph FROM rdf WHERE ok
  UNION ALL SELECT k, topic, s, '<http://example.org/nation>', o, g FROM rdf WHERE ok)"""


@query(f'WITH {_RDF} SELECT topic, k AS "offset", subject, predicate, object, graph FROM quads')
def rdf_to_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rdf_ops.rdf_to_quads(views.rdf_messages(spark, sf_dir)).drop("partition")


@query("""SELECT c_custkey AS "offset", CASE WHEN c_custkey % 14 = 0 THEN 'application/n-triples'
  ELSE 'application/n-quads' END AS content_type FROM customer
  WHERE c_custkey % 14 = 0 OR (c_custkey % 10 = 0 AND c_custkey % 11 <> 0)""")
def unparsable_rdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rdf_ops.unparsable_rdf(views.rdf_messages(spark, sf_dir)).select("offset", "content_type")


@query(f"""WITH {_RDF}, lines AS (
    SELECT k, string_agg(concat_ws(' ', subject, predicate, object, graph) || ' .' || chr(10), '' ORDER BY predicate) AS t
    FROM quads GROUP BY k)
  SELECT c_custkey AS "offset", l.t IS NOT NULL AS rewritten, sha256(coalesce(l.t,
      '<http://example.org/c/' || c_custkey || '> <http://example.org/name> "' || c_name || '"'
      || CASE WHEN c_custkey % 3 = 0 THEN '^^<http://www.w3.org/2001/XMLSchema#string>' ELSE '' END
      || CASE WHEN c_custkey % 7 = 0 THEN ' <http://example.org/g>' ELSE '' END || ' . ' || nation || ' .' || chr(10)
      || CASE WHEN c_custkey % 6 = 0 THEN '# again' || chr(10) || nation || ' .' ELSE '' END
      || CASE WHEN c_custkey % 10 = 0 THEN ' <http://example.org/<<value>>> .' ELSE '' END)) AS checksum
  FROM (SELECT *, '<http://example.org/c/' || c_custkey || '> <http://example.org/nation>' || chr(9)
          || '<http://example.org/n/' || c_nationkey || '>'
          || CASE WHEN c_custkey % 7 = 0 THEN ' <http://example.org/g>' ELSE '' END AS nation FROM customer) c
  LEFT JOIN lines l ON l.k = c.c_custkey""")
def normalise_rdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = views.rdf_messages(spark, sf_dir)
    shaped = base.withColumn("shaped", rdf.normalise_rdf(F.col("value"), F.col("headers")))
    return shaped.select(
        "offset", (F.col("shaped") != F.col("value")).alias("rewritten"), F.sha2("shaped", 256).alias("checksum")
    )


_METADATA = """CASE WHEN pos % 8 = 0 THEN 'acme' WHEN pos % 5 = 0 THEN 'org-' || lang
    WHEN pos % 13 = 0 AND NOT bad AND NOT blank THEN 'GOV' ELSE 'hub' END AS org_name,
  CASE WHEN pos % 8 = 0 THEN 'avro' WHEN pos % 15 = 0 THEN 'eq' END AS schema_type,
  CASE WHEN pos % 8 = 0 THEN 'gas' END AS product_type"""


@query(f'WITH {MESSAGES} SELECT pos AS "offset", {_METADATA} FROM messages')
def exchange_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exchange.exchange_metadata(F.col("headers"), F.lit("hub"))
    return views.messages(spark, sf_dir).select("offset", found.alias("m")).select("offset", "m.*")


@query("""SELECT event_type AS topic, CASE WHEN event_id % 3 = 0 THEN 'out-' || user_id ELSE 'hub-' || event_type END
    AS target, CASE WHEN event_id % 2 = 0 THEN 'pre-hub-' ELSE 'hub-' END || event_type AS compound, event_id FROM events""")
def target_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    configured = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("out-"), F.col("user_id").cast("string"))).otherwise("")
    prefix = F.when(F.col("event_id") % 2 == 0, "pre").otherwise("")
    topic = F.col("event_type")
    return views.table(spark, sf_dir, "events").select(
        topic.alias("topic"),
        txt.target_topic(topic, configured, F.lit("hub")).alias("target"),
        txt.compound_topic(topic, prefix, F.lit("hub")).alias("compound"),
        "event_id",
    )


@query("""SELECT 'hub-' || event_type AS topic, count(*) AS messages, sum(strlen(props))::BIGINT AS bytes FROM events GROUP BY 1""")
def messages_for_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = for_target(views.event_messages(spark, sf_dir), F.lit(""), F.lit("hub"))
    return rows.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("value")).alias("bytes")
    )


# --- checksums ---------------------------------------------------------------------------------------------------

_ENVELOPES = f"""{MESSAGES}, envelopes AS (
  SELECT *, sha256(text) AS actual, CASE WHEN pos % 97 = 0 THEN sha256(text || 'x') WHEN pos % 89 = 0 THEN ' '
    WHEN pos % 3 = 0 THEN upper(sha256(text)) ELSE sha256(text) END AS expected,
    CASE WHEN pos % 97 = 0 THEN 'FAIL' WHEN pos % 89 = 0 THEN 'ABSENT' ELSE 'PASS' END AS status FROM messages)"""


@query(f"""WITH {_ENVELOPES} SELECT topic, pos AS "offset", status AS checksum_status, actual AS actual_checksum
  FROM envelopes WHERE status <> 'FAIL'""")
def verify_checksum_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = messages.verify_checksum(views.envelopes(spark, sf_dir), "not-an-action")
    return kept.select("topic", "offset", "checksum_status", "actual_checksum")


@query(f"""WITH {_ENVELOPES} SELECT topic, pos AS "offset", status AS checksum_status, actual AS actual_checksum
  FROM envelopes""")
def verify_checksum_log_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = messages.verify_checksum(views.envelopes(spark, sf_dir), "log_only")
    return kept.select("topic", "offset", "checksum_status", "actual_checksum")


@query(f"""WITH {_ENVELOPES} SELECT topic, pos AS "offset" FROM envelopes WHERE status <> 'FAIL'""")
def verify_checksum_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes that were checked once already go through; that a mismatch stops the job is a test."""
    clean = views.envelopes(spark, sf_dir).where(
        F.trim(F.lower("payload_checksum")).isin("") | (F.lower("payload_checksum") == F.sha2("value", 256))
    )
    return messages.verify_checksum(clean, "ABORT").select("topic", "offset")


@query(f"""WITH {_ENVELOPES} SELECT 'c' AS client, 's' AS server, topic, 0 AS partition, max(pos) + 1 AS next_offset
  FROM envelopes GROUP BY topic""")
def next_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    consumed = views.envelopes(spark, sf_dir).withColumns({"client": F.lit("c"), "server": F.lit("s")})
    return messages.next_offsets(consumed)


_REPORT = f"""{_ENVELOPES}, report AS (
  SELECT 'STREAM' AS pattern, {_METADATA.replace('schema_type', 'schema_name').replace('product_type', 'product_name')},
    topic, pos, CASE WHEN trim(expected) = '' THEN 'none' ELSE 'SHA-256' END AS algorithm,
    strlen(text) AS input_bytes, CASE WHEN status = 'FAIL' THEN 0 ELSE strlen(text) END AS output_bytes,
    expected AS expected_checksum, actual AS actual_checksum,
    CASE status WHEN 'FAIL' THEN 'FAIL -- exception' WHEN 'ABSENT' THEN 'ABSENT -- no checksum (tolerated)'
      ELSE 'PASS' END AS match, status FROM envelopes)"""


@query(f"""WITH {_REPORT} SELECT pattern, org_name, schema_name, product_name, topic, pos AS "offset", algorithm,
  input_bytes::BIGINT AS input_bytes, output_bytes::BIGINT AS output_bytes, expected_checksum, actual_checksum, match
  FROM report""")
def checksum_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = messages.with_checksum_status(views.envelopes(spark, sf_dir))
    return messages.checksum_report(checked, "SKIP", F.lit("hub")).drop("exception", "checksum_status")


@query(f"""WITH {_REPORT} SELECT org_name, schema_name, product_name, topic,
  count(*) FILTER (WHERE status = 'PASS') AS ok, count(*) FILTER (WHERE status = 'FAIL') AS mismatch,
  count(*) FILTER (WHERE status = 'ABSENT') AS unchecked, count(*) FILTER (WHERE status = 'FAIL') AS skipped,
  sum(input_bytes)::BIGINT AS input_bytes, sum(output_bytes)::BIGINT AS output_bytes
  FROM report GROUP BY ROLLUP (org_name, schema_name, product_name, topic)""")
def checksum_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = messages.with_checksum_status(views.envelopes(spark, sf_dir))
    report = messages.checksum_report(checked, "SKIP", F.lit("hub"))
    return messages.checksum_summary(report, with_totals=True)


# --- access ------------------------------------------------------------------------------------------------------

_LINES = """lines AS (
  SELECT o_orderkey, 'c' || o_custkey AS consumer_id, 'P' || l_partkey AS product, 'T' || l_suppkey AS topic,
    l_linenumber AS n, l_returnflag AS rf, l_linestatus AS ls FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
granted AS (
  SELECT o_orderkey, consumer_id, product, topic, false AS has_attribute, NULL AS name, NULL AS value FROM lines WHERE n = 1
  UNION ALL SELECT o_orderkey, consumer_id, product, topic, true, 'returnflag', rf FROM lines WHERE n > 2
  UNION ALL SELECT o_orderkey, consumer_id, product, topic, true, 'linestatus', ls FROM lines WHERE n > 1)"""

_REQUESTS = """requests AS (SELECT o_orderkey AS request_id, 'c' || o_custkey AS consumer_id,
  CASE WHEN o_orderkey % 3 = 0 THEN ' t' ELSE 't' END || (o_orderkey % 100) AS topic FROM orders)"""


@query(f"""WITH {_LINES} SELECT 'o' || o_orderkey AS client_id, consumer_id, product, topic, has_attribute,
  name AS attribute_name, value AS attribute_value FROM granted""")
def flatten_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grants.flatten_grants(views.grant_documents(spark, sf_dir)).select(
        "client_id", "consumer_id", "product", "topic", "has_attribute", "attribute_name", "attribute_value"
    )


@query(f"""WITH {_LINES}, {_REQUESTS}, asked AS (SELECT DISTINCT consumer_id, topic FROM requests),
  found AS (SELECT DISTINCT a.consumer_id, a.topic, g.name || '=' || g.value AS pair FROM asked a JOIN granted g
    ON g.consumer_id = a.consumer_id AND g.has_attribute
    AND (lower(g.topic) = lower(a.topic) OR lower(g.product) = lower(a.topic)))
  SELECT a.consumer_id, a.topic, count(f.pair)::INT AS attributes,
    coalesce(string_agg(f.pair, ',' ORDER BY f.pair), '') AS pairs
  FROM asked a LEFT JOIN found f ON f.consumer_id = a.consumer_id AND f.topic = a.topic GROUP BY ALL""")
def attributes_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.grant_rows(spark, sf_dir)
    found = grants.attributes_for(views.topic_requests(spark, sf_dir), rows)
    named = F.transform("attributes", lambda a: F.concat_ws("=", a["name"], a["value"]))
    return found.select(
        "consumer_id", "topic", F.size("attributes").alias("attributes"), F.array_join(F.array_sort(named), ",").alias("pairs")
    )


@query(f"""WITH {_LINES}, {_REQUESTS} SELECT * FROM requests r WHERE EXISTS (SELECT 1 FROM lines g
  WHERE g.consumer_id = r.consumer_id AND lower(g.topic) = lower(trim(r.topic)))""")
def has_topic_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.grant_rows(spark, sf_dir)
    return grants.has_topic_access(views.topic_requests(spark, sf_dir), rows)


@query(f"""WITH {_LINES}, {_REQUESTS} SELECT *, 'Topic (' || topic || ') is not valid for client (' || consumer_id || ').'
  AS details FROM requests r WHERE NOT EXISTS (SELECT 1 FROM lines g
  WHERE g.consumer_id = r.consumer_id AND lower(g.topic) = lower(trim(r.topic)))""")
def denied_topic_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.grant_rows(spark, sf_dir)
    return grants.has_topic_access(views.topic_requests(spark, sf_dir), rows, denied=True, salt=True)


@query(f"""WITH {_LINES} SELECT c_custkey, 'c' || c_custkey AS consumer_id FROM customer
  WHERE 'c' || c_custkey IN (SELECT consumer_id FROM lines)""")
def known_consumer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("consumer_id")
    )
    return grants.known_consumer(customers, views.grant_rows(spark, sf_dir))


def _attributes(*pairs: tuple[str | None, str | None]) -> Column:
    return F.array(
        *[F.struct(F.lit(n).cast("string").alias("name"), F.lit(v).cast("string").alias("value")) for n, v in pairs]
    )


@query(f"""WITH {ENTRIES} SELECT topic, m.pos AS "offset" FROM messages m WHERE NOT bad
  AND EXISTS (SELECT 1 FROM entries e WHERE e.pos = m.pos AND k = 'NATIONALITY' AND v = 'EN')
  AND EXISTS (SELECT 1 FROM entries e WHERE e.pos = m.pos AND k = 'CLEARANCE' AND v = '1')""")
def attribute_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _attributes(("Nationality", "en"), ("clearance", "1"))
    return federation.attribute_filter(views.messages(spark, sf_dir), wanted).select("topic", "offset")


@query(f"""WITH {ENTRIES} SELECT m.pos AS "offset", CASE WHEN bad THEN 'BAD_LABEL'
  WHEN n.v IS NULL THEN 'MISSING_ATTRIBUTE' WHEN n.v <> 'EN' THEN 'VALUE_MISMATCH'
  WHEN c.v IS NULL THEN 'MISSING_ATTRIBUTE' WHEN c.v <> '1' THEN 'VALUE_MISMATCH' ELSE 'INVALID_FILTER' END AS reason
  FROM messages m LEFT JOIN entries n ON n.pos = m.pos AND n.k = 'NATIONALITY'
  LEFT JOIN entries c ON c.pos = m.pos AND c.k = 'CLEARANCE'""")
def refusal_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _attributes(("Nationality", "en"), ("clearance", "1"), ("spare", None))
    return federation.with_refusal_reason(views.messages(spark, sf_dir), wanted).select("offset", "reason")


FEDERATE_SQL = f"""{DECISIONS} SELECT d.consumer AS consumer_id, d.topic, d.pos AS "offset", sha256(m.text) AS payload_checksum
  FROM decisions d JOIN messages m ON m.pos = d.pos WHERE reason IS NULL"""


@query(FEDERATE_SQL)
def federate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = outbound_messages(views.messages(spark, sf_dir), views.grants(spark))
    return sent.select("consumer_id", "topic", "offset", "payload_checksum")


@query(f"""{DECISIONS} SELECT consumer AS consumer_id, topic, pos AS "offset" FROM decisions WHERE reason IS NULL""")
def federate_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing when the grants are too large to broadcast: hot topics are salted, no payload is read."""
    rows = message_source.security_label(views.messages(spark, sf_dir))
    return federation.federate(rows, views.grants(spark), salt=True).select("consumer_id", "topic", "offset")


@query(f"""{DECISIONS} SELECT consumer AS consumer_id, topic, count(*) AS messages FROM decisions WHERE reason IS NULL
  GROUP BY ALL""")
def delivered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = message_source.security_label(views.messages(spark, sf_dir))
    return federation.delivered_counts(federation.federate(rows, views.grants(spark)))


@query(f"""{DECISIONS} SELECT consumer AS consumer_id, topic, pos AS "offset", reason FROM decisions""")
def federate_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = message_source.security_label(views.messages(spark, sf_dir))
    return federation.federate_decisions(rows, views.grants(spark)).select("consumer_id", "topic", "offset", "reason")


@query(f"""{DECISIONS} SELECT d.consumer AS consumer_id, d.topic, d.pos AS "offset", m.pos AS position FROM decisions d
  JOIN messages m ON m.pos = d.pos WHERE reason IS NULL""")
def ordered_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = message_source.security_label(views.messages(spark, sf_dir))
    sent = federation.federate(rows, views.grants(spark)).withColumn("position", F.col("offset"))
    return counts.ordered_delivery(sent).select("consumer_id", "topic", "offset", "position")


_CONSUMERS = sorted({consumer for _, _, consumer, _ in views.POLICY})


@query(f"""{DECISIONS}, asked AS (
    SELECT DISTINCT {_CONSUMERS}[(pos // 7) % {len(_CONSUMERS)} + 1] AS consumer, topic FROM messages),
  asked_rules AS (SELECT a.consumer, a.topic, p.name, p.value FROM asked a JOIN policy p ON p.consumer = a.consumer
    AND p.has_attribute AND (lower(p.topic) = lower(a.topic) OR lower(p.product) = lower(a.topic)))
  SELECT a.consumer AS consumer_id, a.topic, m.pos AS "offset" FROM asked a JOIN messages m ON m.topic = a.topic
  WHERE NOT EXISTS (SELECT 1 FROM asked_rules r LEFT JOIN entries e ON e.pos = m.pos AND e.k = upper(r.name)
    WHERE r.consumer = a.consumer AND r.topic = a.topic AND (m.bad OR r.name IS NULL OR r.value IS NULL OR e.v IS NULL
      OR e.v <> upper(r.value)))""")
def federate_requests_without_grant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested topics of known consumers without a topic grant, as file references are handed out on request."""
    rows = message_source.security_label(views.messages(spark, sf_dir))
    policy = views.grants(spark)
    # Every seven messages another consumer asks for their topics.
    names = F.array(*[F.lit(c) for c in _CONSUMERS])
    place = F.pmod(F.floor(F.col("offset") / 7), F.lit(len(_CONSUMERS))) + 1
    asked = rows.select(F.element_at(names, place.cast("int")).alias("consumer_id"), "topic").distinct()
    sent = federation.federate(rows, policy, requests=asked, require_topic_grant=False)
    return sent.select("consumer_id", "topic", "offset")


@query(f"""{DECISIONS} SELECT d.consumer AS consumer_id, d.pos AS "offset", 'Dead-Letter-Reason=' || d.reason AS last_header
  FROM decisions d WHERE reason IS NOT NULL""")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = message_source.security_label(views.messages(spark, sf_dir))
    letters = messages.dead_letters(federation.refused(federation.federate_decisions(rows, views.grants(spark))))
    last = F.element_at("headers", -1)
    return letters.select("consumer_id", "offset", F.concat_ws("=", last["key"], last["value"]).alias("last_header"))


@query(f"""{DECISIONS}, actual AS (SELECT topic, count(*) AS n FROM decisions WHERE reason IS NULL GROUP BY topic),
  expected AS (SELECT source AS topic, count(*) AS expected FROM documents GROUP BY 1
    UNION ALL SELECT 'none', 0 UNION ALL SELECT 'lost', 3)
  SELECT e.topic, e.expected, coalesce(a.n, 0) AS actual, coalesce(a.n, 0) = e.expected AS ok
  FROM expected e LEFT JOIN actual a ON a.topic = e.topic""")
def verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = message_source.security_label(views.messages(spark, sf_dir))
    sent = federation.federate(rows, views.grants(spark))
    expected = (
        views.table(spark, sf_dir, "documents")
        .groupBy(F.col("source").alias("topic"))
        .agg(F.count(F.lit(1)).alias("expected"))
        .unionByName(spark.createDataFrame([("none", 0), ("lost", 3)], "topic string, expected bigint"))
    )
    return counts.verify_counts(sent, expected)


# --- feeds -------------------------------------------------------------------------------------------------------

_FEEDS = """candidates AS (
  SELECT o_orderkey AS k, o_custkey AS c, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_returnflag AS rf,
    CASE WHEN o_orderkey % 17 = 0 THEN 'INVALID_PRODUCER'
      WHEN o_orderkey % 23 = 0 OR o_orderkey % 19 = 0 THEN 'INVALID_CONNECTION'
      WHEN l_linenumber = 6 THEN 'INVALID_PRODUCT' WHEN l_returnflag NOT IN ('A', 'N') THEN 'UNKNOWN_TYPE'
      WHEN l_linenumber = 7 THEN 'NO_CONFIGURATION' END AS reason
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
feeds AS (
  SELECT 'Cust' || c || '-T' || s AS feed_id, 'Cust' || c AS job_name, 'node-1' AS node_id,
    CASE rf WHEN 'A' THEN 'topic' ELSE 'file' END AS type, 'T' || s AS topic, 'Cust' || c AS server_name,
    'h' || c AS host, CASE WHEN k % 4 = 0 THEN 9000 ELSE 8080 END AS port, k % 5 = 0 AS tls, 'id' || c AS client_name,
    CASE WHEN n <> 3 THEN 'interval' END AS schedule_type,
    CASE n WHEN 4 THEN 'PT5M' WHEN 5 THEN 'soon' ELSE 'PT1H' END AS schedule_expression, 5 AS retries,
    false AS immediate, CASE WHEN rf = 'N' THEN 'out/' || p END AS source_path,
    CASE WHEN rf = 'N' THEN 'in/' || p END AS destination, 'interval' AS effective_type,
    CASE n WHEN 4 THEN 'PT5M' ELSE 'PT1H' END AS effective_expression, c
  FROM candidates WHERE reason IS NULL)"""


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feeds(views.consumer_documents(spark, sf_dir), "node-1")


@query(f"WITH {_FEEDS} SELECT * EXCLUDE (c) FROM feeds")
def feed_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feeds(spark, sf_dir).select(
        *feeds.FEED_COLUMNS,
        F.col("effective_schedule.schedule_type").alias("effective_type"),
        F.col("effective_schedule.schedule_expression").alias("effective_expression"),
    )


@query(f"""WITH {_FEEDS} SELECT 'o' || k AS document_client, 'P' || p AS product,
  CASE WHEN n <> 6 THEN 'T' || s END AS topic, reason,
  CASE WHEN reason = 'INVALID_CONNECTION' THEN CASE WHEN k % 23 = 0 THEN 'client name is blank'
    ELSE 'server port is negative' END END AS details FROM candidates WHERE reason IS NOT NULL""")
def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.feed_rejects(views.consumer_documents(spark, sf_dir), "node-1").drop("producer")


@query("""SELECT s_suppkey, s_name IS NOT NULL AND s_suppkey % 3 <> 0 AS producer_ok, s_suppkey % 2 = 0 AS product_ok,
  CASE WHEN s_suppkey % 5 = 0 THEN 'client name is blank' WHEN s_suppkey % 7 = 0 THEN 'client key is blank'
    WHEN s_suppkey % 11 = 0 THEN 'server host is blank' WHEN s_acctbal < 0 THEN 'server port is negative'
    ELSE 'server name is not alphanumeric' END AS problem FROM supplier""")
def connection_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    products = F.when(key % 3 != 0, F.array(F.struct(F.lit("t").alias("topic"))))
    producer = F.struct(products.alias("products"), F.col("s_name").alias("name"), F.lit("h").alias("host"))
    product = F.struct(F.lit("t").alias("topic"), F.when(key % 2 == 0, "FILE").otherwise("other").alias("type"))
    problem = feeds.connection_problem(
        F.when(key % 5 != 0, "c"),
        F.when(key % 7 != 0, "k").otherwise(" "),
        F.when(key % 11 != 0, "h").otherwise(""),
        F.col("s_acctbal"),
        F.col("s_name"),
    )
    return views.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        feeds.valid_producer(producer).alias("producer_ok"),
        feeds.valid_product(product).alias("product_ok"),
        problem.alias("problem"),
    )


@query(f"""WITH {_FEEDS} SELECT feed_id, client_name, topic, type FROM feeds WHERE c % 9 <> 0 AND c % 4 = 0""")
def active_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(
        F.array(*[F.lit(s) for s in ("ACTIVE", "REVOKED", "EXPIRED", "odd")]), (F.col("c_custkey") % 4 + 1).cast("int")
    )
    listed = views.table(spark, sf_dir, "customer").where("c_custkey % 9 <> 0").select(
        F.concat(F.lit("id"), F.col("c_custkey").cast("string")).alias("client_id"), status.alias("status")
    )
    return grants.active_feeds(_feeds(spark, sf_dir), listed).select("feed_id", "client_name", "topic", "type")


@query("""WITH cur AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderstatus <> 'P'),
  req AS (SELECT o_orderkey, o_totalprice + (o_orderkey % 10 = 2)::INT AS o_totalprice, o_orderpriority FROM orders
    WHERE o_orderkey % 10 <> 1 AND o_orderstatus <> 'P')
  SELECT coalesce(c.o_orderkey, r.o_orderkey) AS o_orderkey, CASE WHEN r.o_orderkey IS NULL THEN 'DELETE'
    WHEN c.o_orderkey IS NULL THEN 'ADD' WHEN c.o_totalprice = r.o_totalprice THEN 'KEEP' ELSE 'REPLACE' END AS action,
    c.o_totalprice AS price_before, r.o_totalprice AS price_after
  FROM cur c FULL JOIN req r ON c.o_orderkey = r.o_orderkey""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    changed = orders.where("o_orderkey % 10 <> 1").withColumn(
        "o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 10 == 2, 1.0).otherwise(0.0)
    )
    diff = snapshots.snapshot_diff(
        orders.where("o_orderkey % 10 <> 0"),
        changed,
        ["o_orderkey"],
        compare=["o_totalprice", "o_orderpriority"],
        scope=F.col("o_orderstatus") != "P",
    )
    return diff.select(
        "o_orderkey",
        "action",
        F.col("current.o_totalprice").alias("price_before"),
        F.col("requested.o_totalprice").alias("price_after"),
    )


@query("""WITH last AS (SELECT user_id, arg_max(event_type, event_id) AS t, arg_max(value, event_id) AS v FROM events
    GROUP BY user_id),
  cur AS (SELECT user_id, arg_min(event_type, event_id) AS t, arg_min(value, event_id) AS v FROM events GROUP BY user_id)
  SELECT l.user_id, l.t AS event_type, l.v AS value,
    CASE WHEN l.t = c.t AND l.v = c.v THEN 'KEEP' ELSE 'REPLACE' END AS action FROM last l JOIN cur c USING (user_id)""")
def last_request_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    first = snapshots.last_request_wins(events.withColumn("event_id", -F.col("event_id")), ["user_id"], "event_id")
    diff = snapshots.snapshot_diff(first, events, ["user_id"], compare=["event_type", "value"], order="event_id")
    return diff.select("user_id", "requested.event_type", "requested.value", "action")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (1, 4) THEN 'cron' ELSE 'interval' END AS schedule_type,
  CASE o_orderkey % 7 WHEN 1 THEN '0 0 * * * *' WHEN 2 THEN 'PT' || (o_orderkey % 60) || 'M' WHEN 4 THEN '*/5 ' ||
    (o_orderkey % 24) || ' * * MON-FRI' ELSE 'PT1H' END AS schedule_expression FROM orders""")
def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    case = key % 7
    kind = F.when(case.isin(1, 3, 4), "CRON").when(case.isin(2, 5, 0), "interval").otherwise("weird")
    expression = (
        F.when(case == 1, "0 0 * * * *")
        .when(case == 2, F.concat(F.lit("PT"), (key % 60).cast("string"), F.lit("M")))
        .when(case == 3, "* * * *")
        .when(case == 4, F.concat(F.lit("*/5 "), (key % 24).cast("string"), F.lit(" * * MON-FRI")))
        .when(case == 5, "5 minutes")
        .when(case == 6, "PT10M")
    )
    return (
        views.table(spark, sf_dir, "orders")
        .select("o_orderkey", naming.normalise_schedule(kind, expression).alias("s"))
        .select("o_orderkey", "s.*")
    )


@query("""SELECT c_custkey, 'Customer' || substr(c_name, 10) AS server_name,
  CASE WHEN c_custkey % 3 = 2 THEN 'ftp://h' ELSE 'h' END || c_custkey AS host, 'Producer' AS unnamed FROM customer""")
def cleaned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    scheme = F.element_at(
        F.array(F.lit("https://h"), F.lit("http://h"), F.lit("ftp://h")), (F.col("c_custkey") % 3 + 1).cast("int")
    )
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        naming.clean_server_name(F.col("c_name")).alias("server_name"),
        naming.clean_host(F.concat(scheme, F.col("c_custkey").cast("string"))).alias("host"),
        naming.clean_server_name(F.lit(" #- ")).alias("unnamed"),
    )


# --- names of files ----------------------------------------------------------------------------------------------

_PATHS = """paths AS (SELECT doc_id AS k, source AS s, lang AS l, CASE doc_id % 5
  WHEN 0 THEN 'in/' || lang || '-' || source || '-p' || doc_id || '-v1.nt' WHEN 1 THEN lang || '-' || source || '.nt'
  WHEN 2 THEN 'a.b\\\\' || lang || '- ' || source || ' -q.x.csv' WHEN 3 THEN ' in/' || source || '/ '
  ELSE '/in/' || lang || '--' || source || '-z' END AS path FROM documents)""".replace("\\\\", "\\")


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    case, doc = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    path = (
        F.when(case == 0, F.concat(F.lit("in/"), "lang", F.lit("-"), "source", F.lit("-p"), doc, F.lit("-v1.nt")))
        .when(case == 1, F.concat("lang", F.lit("-"), "source", F.lit(".nt")))
        .when(case == 2, F.concat(F.lit("a.b\\"), "lang", F.lit("- "), "source", F.lit(" -q.x.csv")))
        .when(case == 3, F.concat(F.lit(" in/"), "source", F.lit("/ ")))
        .otherwise(F.concat(F.lit("/in/"), "lang", F.lit("--"), "source", F.lit("-z")))
    )
    return views.table(spark, sf_dir, "documents").select("doc_id", "source", "lang", path.alias("path"))


@query(f"""WITH {_PATHS} SELECT k AS doc_id, CASE WHEN k % 5 IN (0, 2) THEN l END AS schema,
  CASE WHEN k % 5 IN (0, 2) THEN s END AS org, CASE k % 5 WHEN 0 THEN 'p' || k WHEN 2 THEN 'q.x' END AS product
  FROM paths""")
def destination_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = naming.destination_metadata(F.col("path"))
    return _paths(spark, sf_dir).select("doc_id", found.alias("m")).select("doc_id", "m.schema", "m.org", "m.product")


@query(f"""WITH {_PATHS} SELECT k AS doc_id,
  CASE k % 5 WHEN 0 THEN 'in/' || l || '-' || s || '-p' || k || '.nt' WHEN 1 THEN l || '-' || s || '.nt'
    WHEN 2 THEN 'a.b' || chr(92) || l || '-' || s || '-q.x.csv' WHEN 3 THEN 'in/' || s || '/f' || k || '.txt'
    ELSE '/in/' || l || '--' || s || '-z' END AS plain,
  CASE k % 5 WHEN 0 THEN 'in/' || l || '-' || s || '-p' || k || '-v7.nt' WHEN 1 THEN l || '-' || s || '-v7.nt'
    WHEN 2 THEN 'a.b' || chr(92) || l || '-' || s || '-q.x-v7.csv' WHEN 3 THEN 'in/' || s || '/f' || k || '-v7.txt'
    ELSE '/in/' || l || '--' || s || '-z-v7' END AS versioned,
  CASE k % 5 WHEN 0 THEN l || '-' || s || '-p' || k WHEN 1 THEN l || '-' || s WHEN 2 THEN l || '-' || s || '-q.x'
    WHEN 3 THEN s ELSE l || '--' || s || '-z' END AS product_key,
  CASE k % 5 WHEN 0 THEN 'in/' || l || '-' || s || '-p' || k || '-v1.nt' WHEN 1 THEN l || '-' || s || '.nt'
    WHEN 2 THEN path WHEN 3 THEN 'in/' || s || '/f' || k || '.txt' ELSE 'in/' || l || '--' || s || '-z' END AS object_key
  FROM paths""")
def destination_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    source = F.concat(F.lit("x/y/f"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return _paths(spark, sf_dir).select(
        "doc_id",
        naming.unversioned_destination(path, source).alias("plain"),
        naming.versioned_destination(path, source, F.lit(7)).alias("versioned"),
        naming.product_key(path).alias("product_key"),
        naming.storage_key(path, source).alias("object_key"),
    )


# --- files -------------------------------------------------------------------------------------------------------

_REFERENCES = """refs AS (SELECT doc_id AS k, source, doc_id % 20 AS c,
  CASE doc_id % 4 WHEN 0 THEN 'S3' WHEN 1 THEN 'AZURE' WHEN 2 THEN 'GCP' ELSE 'LOCAL' END AS kind,
  CASE doc_id % 4 WHEN 0 THEN 's3a://box' WHEN 1 THEN 'abfss://box@acct.dfs.core.windows.net' WHEN 2 THEN 'gs://box' ELSE 'file:' END
    || '/d/' || doc_id || '.txt' AS uri, n_chars FROM documents),
checked AS (SELECT *, CASE WHEN c IN (1, 5, 7, 10) THEN 'DESERIALIZATION' WHEN c IN (2, 3, 6, 9) THEN 'VALIDATION'
  WHEN k % 8 = 0 THEN 'VALIDATION' WHEN k % 12 = 3 THEN 'VALIDATION' END AS reason FROM refs)"""


@query(f"""WITH {_REFERENCES} SELECT k AS file_sequence_id, source AS topic,
  CASE WHEN c IN (1, 10) THEN 'BAD' WHEN c IN (2, 9) THEN 'NULL' ELSE 'OK' END AS parse_state,
  CASE WHEN c IN (1, 2, 7, 9, 10) THEN NULL WHEN c = 3 THEN 'S3' WHEN c = 5 THEN 's3' WHEN c = 6 THEN 'GCP' ELSE kind END
    AS source_type FROM refs""")
def decode_file_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = files.decode_file_requests(views.file_reference_messages(spark, sf_dir), "acct")
    return decoded.select("file_sequence_id", "topic", "parse_state", "source_type")


@query(f"""WITH {_REFERENCES} SELECT k AS file_sequence_id, kind AS source_type, uri, n_chars AS size
  FROM checked WHERE reason IS NULL""")
def valid_file_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = files.decode_file_requests(views.file_reference_messages(spark, sf_dir), "acct")
    checked = files.check_file_requests(decoded, views.file_listing(spark, sf_dir))
    return files.valid_file_requests(checked).select("file_sequence_id", "source_type", "uri", "size")


@query(f"""WITH {_REFERENCES} SELECT k AS file_sequence_id, source AS topic, reason, CASE
  WHEN c IN (2, 9) THEN 'request is null' WHEN c IN (1, 10) THEN 'not a file request'
  WHEN c = 7 THEN 'type and path are required' WHEN c = 5 THEN 'unknown type s3' WHEN c = 3 THEN 'path is blank'
  WHEN c = 6 THEN 'storage container is required' WHEN k % 8 = 0 THEN 'object does not exist: /d/' || k || '.txt'
  ELSE 'not a file: /d/' || k || '.txt' END AS details FROM checked WHERE reason IS NOT NULL""")
def rejected_file_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = files.decode_file_requests(views.file_reference_messages(spark, sf_dir), "acct")
    checked = files.check_file_requests(decoded, views.file_listing(spark, sf_dir), salt=True)
    return files.rejected_file_requests(checked).drop("partition")


_FILES = """files AS (SELECT doc_id AS k, lang || '-doc' || doc_id || '.txt' AS name, encode(text) AS content FROM documents
  UNION ALL SELECT doc_id + 1000000000, lang || '-doc' || (doc_id + 1000000000) || '.txt', ''::BLOB FROM documents
  WHERE doc_id % 41 = 0),
sized AS (SELECT *, octet_length(content) AS size, ceil(octet_length(content) / 1000.0)::INT AS total FROM files)"""


@query(f"""WITH {_FILES}, numbered AS (SELECT *, unnest(range(0, total + 1))::INT AS i FROM sized)
  SELECT k AS file_sequence_id, name AS file_name, i AS chunk_index, total AS total_chunks, i = total AS is_last_chunk,
    CASE WHEN i < total THEN sha256(content[i * 1000 + 1 : i * 1000 + 1000]) END AS chunk_digest, size AS file_size,
    CASE WHEN i = total THEN sha256(content) END AS file_checksum FROM numbered""")
def chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = files.chunk_files(views.files(spark, sf_dir), 1000)
    return chunks.select(
        "file_sequence_id",
        "file_name",
        "chunk_index",
        "total_chunks",
        "is_last_chunk",
        F.sha2("chunk_data", 256).alias("chunk_digest"),
        "file_size",
        "file_checksum",
    )


def _received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks as they might arrive: some lost, some twice, some files without their marker."""
    sent = files.chunk_files(views.files(spark, sf_dir), 1000)
    lost = (F.col("file_sequence_id") % 97 == 0) & (F.col("chunk_index") == 0) & ~F.col("is_last_chunk")
    unfinished = (F.col("file_sequence_id") % 89 == 0) & F.col("is_last_chunk")
    copies = F.when(F.col("file_sequence_id") % 83 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return sent.where(~lost & ~unfinished).withColumn("copy", F.explode(copies)).drop("copy")


_RECEIVED = f"""{_FILES}, received AS (SELECT *, total - (k % 97 = 0 AND total > 0)::INT AS arrived,
  CASE WHEN k % 97 = 0 THEN content[1001 : size] ELSE content END AS actual FROM sized)"""


@query(f"""WITH {_RECEIVED} SELECT k AS file_sequence_id, name AS file_name, total AS total_chunks, arrived::BIGINT AS chunk_count,
  size AS file_size, sha256(content) AS file_checksum, octet_length(actual) AS actual_size, sha256(actual) AS actual_checksum
  FROM received WHERE k % 89 <> 0""")
def assemble_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and digest are those of the bytes returned, of small files and of files of many blocks alike."""
    keys = ["file_sequence_id", "file_name"]
    chunks = _received(spark, sf_dir)
    whole = files.joined_blocks(files.file_blocks(chunks, block_chunks=8))
    facts = files.assemble_files(chunks, block_chunks=8).drop("block_count", "actual_size", "actual_checksum")
    return facts.join(whole, keys).select(
        *keys,
        "chunk_count",
        "total_chunks",
        "file_size",
        "file_checksum",
        F.octet_length("content").cast("bigint").alias("actual_size"),
        F.sha2("content", 256).alias("actual_checksum"),
    )


@query(f"""WITH {_RECEIVED} SELECT k AS file_sequence_id, name AS file_name, NOT (k % 97 = 0 AND size > 0) AS checksum_ok,
  NOT (k % 97 = 0 AND size > 0) AS size_ok, CASE WHEN k % 97 = 0 AND size > 0 THEN 'CHECKSUM_MISMATCH' END AS error
  FROM received WHERE k % 89 <> 0""")
def verify_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = files.verify_files(files.assemble_files(_received(spark, sf_dir)))
    return checked.select("file_sequence_id", "file_name", "checksum_ok", "size_ok", "error")


@query(f"""WITH {_RECEIVED} SELECT k AS file_sequence_id, name AS file_name,
  (arrived * CASE WHEN k % 83 = 0 THEN 2 ELSE 1 END)::BIGINT AS received,
  CASE WHEN k % 83 = 0 THEN arrived ELSE 0 END::BIGINT AS repeated, (total - arrived)::BIGINT AS missing,
  k % 97 = 0 AND total > 1 AS has_gaps, total AS total_chunks, k % 89 <> 0 AS finished,
  0::BIGINT AS conflicting FROM received WHERE k % 89 <> 0 OR arrived > 0""")
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.chunk_counts(_received(spark, sf_dir))


@query(f"""WITH {_RECEIVED} SELECT 'FILE' AS pattern, CASE WHEN k % 2 = 0 THEN 'o' ELSE 'hub' END AS org_name,
  CASE WHEN k % 2 = 0 THEN 's' END AS schema_name, CASE WHEN k % 2 = 0 THEN 'p' END AS product_name, name AS file_name,
  k AS file_sequence_id, total AS total_chunks, 'SHA-256' AS algorithm, size AS input_bytes,
  CASE WHEN k % 97 = 0 AND size > 0 THEN 0 ELSE size END::BIGINT AS output_bytes,
  CASE WHEN k % 97 = 0 AND size > 0 THEN 'FAIL -- exception' ELSE 'PASS' END AS match FROM received WHERE k % 89 <> 0""")
def file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = files.verify_files(files.assemble_files(_received(spark, sf_dir)))
    destination = F.when(F.col("file_sequence_id") % 2 == 0, "in/s-o-p.nt").otherwise("in/other.nt")
    return messages.file_report(checked, destination, F.lit("hub")).drop(
        "storage_provider", "expected_checksum", "actual_checksum", "exception", "checksum_status"
    )


@query(f"""WITH {_REFERENCES} SELECT k AS file_sequence_id, 'SKIPPED' AS match, 0::BIGINT AS output_bytes,
  split_part(reason, ' ', 1) AS reason FROM checked WHERE reason IS NOT NULL""")
def skipped_file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = files.decode_file_requests(views.file_reference_messages(spark, sf_dir), "acct")
    rejects = files.rejected_file_requests(files.check_file_requests(decoded, views.file_listing(spark, sf_dir)))
    return messages.skipped_file_report(rejects).select(
        "file_sequence_id", "match", "output_bytes", F.substring_index("exception", ":", 1).alias("reason")
    )


@query(f"""WITH {_REFERENCES} SELECT source AS topic, max(k) + 1 AS next_sequence_id FROM checked GROUP BY source""")
def file_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = files.decode_file_requests(views.file_reference_messages(spark, sf_dir), "acct")
    checked = files.check_file_requests(decoded, views.file_listing(spark, sf_dir))
    return files.file_progress(files.valid_file_requests(checked), files.rejected_file_requests(checked))


@query("""SELECT 'r' || r_regionkey AS consumer_id, 't' || (doc_id % 2) AS topic, doc_id // 2 AS file_sequence_id,
  sha256(text) AS actual_checksum FROM documents JOIN region ON r_regionkey % 2 = doc_id % 2""")
def outbound_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File references of two topics with the same offsets and file names: what each consumer gets, put together again."""
    root = scratch_path(spark, "outbound")
    store = f"{root}/store" if "://" in root or root.startswith("file:") else f"file:{root}/store"
    local = store.removeprefix("file:")
    documents = views.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("t"), F.col("doc_id") % 2).alias("topic"), F.floor(F.col("doc_id") / 2).alias("offset"), "text"
    )
    name = F.concat(F.lit(f"{local}/"), "topic", F.lit("/"), F.col("offset").cast("string"), F.lit(".txt"))
    given = documents.select(
        F.col("offset").alias("file_sequence_id"), F.concat(F.lit("file:"), name).alias("uri"), F.encode("text", "UTF-8").alias("content")
    )
    stored = written(write_files(given), f"{root}/given")
    messages_in = documents.select(
        "topic",
        F.lit(0).alias("partition"),
        "offset",
        F.current_timestamp().alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.encode(F.to_json(F.struct(F.lit("LOCAL").alias("sourceType"), name.alias("path"))), "UTF-8").alias("value"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    ).where(F.lit(stored.where("NOT ok").isEmpty()))
    regions = views.table(spark, sf_dir, "region")
    grants = regions.select(
        F.concat(F.lit("t"), F.col("r_regionkey") % 2).alias("topic"),
        F.lit("files").alias("product"),
        F.concat(F.lit("r"), "r_regionkey").alias("consumer_id"),
        F.lit(0).alias("position"),
        F.lit(False).alias("has_attribute"),
        F.lit(None).cast("string").alias("attribute_name"),
        F.lit(None).cast("string").alias("attribute_value"),
    )
    chunks, deliveries, _ = outbound_file_plan(messages_in, grants, chunk_size=1000, work=f"{root}/work")
    sent = chunks.join(deliveries, ["topic", "partition", "file_sequence_id"])
    built = files.assemble_files(sent, by=["consumer_id", "topic", "partition"])
    return built.select("consumer_id", "topic", "file_sequence_id", "actual_checksum")


# --- versions ----------------------------------------------------------------------------------------------------

_VERSIONS = """planned AS (SELECT doc_id AS k, CASE WHEN doc_id % 3 = 0 THEN 'hot-a-b' ELSE source || '-' || lang || '-p'
    || (doc_id // 50) END AS pk FROM documents),
counted AS (SELECT *, count(*) OVER (PARTITION BY pk) AS n, row_number() OVER (PARTITION BY pk ORDER BY k) AS rn,
    CASE WHEN length(pk) % 2 = 0 THEN length(pk) ELSE 0 END AS counter FROM planned)"""


def _plan(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = views.table(spark, sf_dir, "documents")
    key = F.when(F.col("doc_id") % 3 == 0, "hot-a-b").otherwise(
        F.concat_ws("-", "source", "lang", F.concat(F.lit("p"), F.floor(F.col("doc_id") / 50).cast("string")))
    )
    named = docs.select(
        F.col("doc_id").alias("file_sequence_id"),
        F.concat(F.lit("in/"), key, F.lit("-more.txt")).alias("destination"),
        F.lit("x.txt").alias("file_name"),
    )
    counters = (
        docs.select(key.alias("product_key"))
        .distinct()
        .where(F.length("product_key") % 2 == 0)
        .withColumn("counter", F.length("product_key").cast("bigint"))
    )
    return named, counters


@query(f"""WITH {_VERSIONS} SELECT k AS file_sequence_id, pk AS product_key, n AS run_files,
  CASE WHEN n > 1 THEN counter + rn END AS version,
  'in/' || pk || CASE WHEN n > 1 THEN '-v' || (counter + rn) ELSE '' END || '.txt' AS final_destination FROM counted""")
def plan_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, counters = _plan(spark, sf_dir)
    return versions.plan_versions(named, counters, width=100).select(
        "file_sequence_id", "product_key", "run_files", "version", "final_destination"
    )


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").select(
        F.col("source").alias("run"), F.col("doc_id").alias("file_sequence_id"), (F.col("doc_id") % 37 != 30).alias("ok")
    )


@query("""WITH failed AS (SELECT source, min(doc_id) AS at FROM documents WHERE doc_id % 37 = 30 GROUP BY source)
  SELECT d.source AS run, doc_id AS file_sequence_id FROM documents d LEFT JOIN failed f ON f.source = d.source
  WHERE f.at IS NULL OR doc_id < f.at""")
def store_until_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.store_until_first_failure(_results(spark, sf_dir)).select("run", "file_sequence_id")


@query(f"""WITH {_VERSIONS}, before AS (SELECT DISTINCT pk, length(pk) AS c FROM planned WHERE length(pk) % 2 = 0),
  failed AS (SELECT DISTINCT source FROM documents WHERE doc_id % 37 = 30),
  broken AS (SELECT DISTINCT pk FROM counted JOIN documents ON doc_id = k WHERE source IN (SELECT source FROM failed)),
  advanced AS (SELECT pk, max(counter + rn) AS a FROM counted WHERE n > 1 AND pk NOT IN (SELECT pk FROM broken) GROUP BY pk)
  SELECT coalesce(a.pk, b.pk) AS product_key, coalesce(a.a, b.c) AS counter FROM before b FULL JOIN advanced a ON a.pk = b.pk""")
def next_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    named, counters = _plan(spark, sf_dir)
    runs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_sequence_id"), F.col("source").alias("run")
    )
    plan = versions.plan_versions(named, counters).join(runs, "file_sequence_id")
    failures = versions.first_failures(_results(spark, sf_dir))
    return versions.next_counters(plan, counters, failures)


# --- sources and progress ----------------------------------------------------------------------------------------


@query("""SELECT doc_id AS "offset", 'nationality=' || upper(lang) AS label, 'application/n-triples' AS content_type,
  '<s:' || doc_id || '> <p> "' || source || '" .' AS payload FROM documents""")
def tagged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        F.lit("Security-Label:nationality="),
        F.upper("lang"),
        F.lit("\u00acContent-Type:application/n-triples\t<s:"),
        F.col("doc_id").cast("string"),
        F.lit('> <p> "'),
        "source",
        F.lit('" .'),
    )
    lines = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("offset"), line.alias("value"))
    parsed = message_source.tagged_text(lines, "knowledge")
    return parsed.select(
        "offset",
        hdr.header_first(F.col("headers"), "Security-Label").alias("label"),
        hdr.header_last(F.col("headers"), "Content-Type").alias("content_type"),
        F.decode("value", "UTF-8").alias("payload"),
    )


_STARTS = """committed AS (SELECT event_type AS topic, (user_id % 8)::INT AS partition, max(event_id) + 1 AS c FROM events
    WHERE user_id % 8 % 3 <> 0 GROUP BY ALL),
  requested AS (SELECT DISTINCT event_type AS topic, (user_id % 8)::INT AS partition,
    CASE WHEN user_id % 2 = 0 THEN -2 ELSE 10 END AS r FROM events WHERE user_id % 8 <> 1)"""


def _starts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = views.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 8).cast("int").alias("partition"), "event_id"
    )
    committed = events.where("partition % 3 <> 0").groupBy("topic", "partition").agg(
        (F.max("event_id") + 1).alias("next_offset")
    )
    requested = events.where("partition <> 1").select("topic", "partition").distinct()
    offset = F.when(F.col("partition") % 2 == 0, 0).otherwise(10).cast("bigint")
    return committed, requested.withColumn("offset", offset)


@query(f"""WITH {_STARTS} SELECT coalesce(c.topic, r.topic) AS topic, coalesce(c.partition, r.partition) AS partition,
  coalesce(c, r)::BIGINT AS "offset", c IS NULL AS is_seek
  FROM committed c FULL JOIN requested r ON c.topic = r.topic AND c.partition = r.partition""")
def start_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_source.start_offsets(*_starts(spark, sf_dir))


@query(f"""WITH {_STARTS} SELECT coalesce(c.topic, r.topic) AS topic, coalesce(c.partition, r.partition) AS partition,
  coalesce(r, c)::BIGINT AS "offset", r IS NOT NULL AS is_seek
  FROM committed c FULL JOIN requested r ON c.topic = r.topic AND c.partition = r.partition""")
def start_offsets_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_source.start_offsets(*_starts(spark, sf_dir), force_reset=True)


@query("""WITH runs AS (SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id // 1000 AS run,
    max(event_id) + 1 AS n FROM events GROUP BY ALL)
  SELECT 'c' AS client, 's' AS server, topic, partition, arg_max(n, run) AS next_offset, max(run) AS run
  FROM runs GROUP BY topic, partition""")
def merged_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.event_messages(spark, sf_dir).withColumns(
        {"client": F.lit("c"), "server": F.lit("s"), "run": F.floor(F.col("offset") / 1000)}
    )
    return merge_progress(messages.next_offsets(rows, ["client", "server", "topic", "partition", "run"]))


@query("""SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS "offset", props AS value FROM events
  WHERE event_type IN ('click', 'view')""")
def read_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = message_source.read_messages(spark, views.event_messages(spark, sf_dir), ["click", "view"])
    return found.select("topic", "partition", "offset", F.decode("value", "UTF-8").alias("value"))


# --- streams and stores ------------------------------------------------------------------------------------------

def _event_delivery(policy: list) -> str:
    """Decisions about the events under a policy."""
    return f"""WITH messages AS (
    SELECT event_id AS pos, event_type AS topic, (user_id % 4)::INT AS partition, event_id % 100 = 0 AS bad, props, value,
      user_id FROM events),
  entries AS (SELECT pos, 'LEVEL' AS k, CASE WHEN value >= 20 THEN 'HIGH' ELSE 'LOW' END AS v FROM messages WHERE NOT bad
    UNION ALL SELECT pos, 'HOME', (user_id % 5)::VARCHAR FROM messages WHERE NOT bad),
  {_policy(policy)}, {_JUDGED}"""


_EVENT_DELIVERY = _event_delivery(views.EVENT_POLICY)


#: Bytes of a file that a stream reads, about.
FED_BYTES = 16 << 20


def _feed(rows: DataFrame, path: str, key: Column, size: Column, *, files: int, each: int) -> int:
    """Add rows to the folder of a stream, dealt by ``key``: as that many files, or more where rows of ``size`` bytes are many.

    Gives the number of files of a micro-batch: ``each`` of ``files``, in proportion, so that micro-batches grow and not their number.
    """
    total = rows.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    dealt = max(files, -(-total // FED_BYTES))
    rows.repartition(dealt, key).write.mode("append").parquet(path)
    return -(-dealt * each // files)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return views.as_event_messages(stream)


@query(f"""{_EVENT_DELIVERY} SELECT d.consumer AS consumer_id, d.topic, m.partition, d.pos AS "offset", reason,
  CASE WHEN reason IS NULL THEN sha256(m.props) END AS payload_checksum FROM decisions d JOIN messages m ON m.pos = d.pos""")
def drained_federation(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "drained")
    streams.run_federation(
        _event_stream(spark, sf_dir), views.event_grants(spark), f"{root}/sink", f"{root}/checkpoint"
    ).awaitTermination()
    return streams.read_sink(spark, f"{root}/sink").select(
        "consumer_id", "topic", "partition", "offset", "reason", "payload_checksum"
    )


@query(f"""{_EVENT_DELIVERY} SELECT d.consumer AS consumer_id, d.topic, m.partition, d.pos AS "offset", reason,
  CASE WHEN reason IS NULL THEN sha256(m.props) END AS payload_checksum FROM decisions d JOIN messages m ON m.pos = d.pos""")
def federated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the drained stream from one batch over the same events."""
    rows = views.event_messages(spark, sf_dir)
    decided = federation.federate_decisions(rows, views.event_grants(spark), shape=messages.to_envelope)
    return decided.select("consumer_id", "topic", "partition", "offset", "reason", "payload_checksum")


@query(f"""{_EVENT_DELIVERY} SELECT d.consumer AS client, 'hub' AS server, d.topic, m.partition,
  max(d.pos) + 1 AS next_offset FROM decisions d JOIN messages m ON m.pos = d.pos WHERE reason IS NULL GROUP BY ALL""")
def drained_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "progress")
    progress = ProgressTable(spark, f"{root}/progress")
    writer = streams.outbound_writer(views.event_grants(spark), f"{root}/sink", server="hub", progress=progress)
    streams.drain(_event_stream(spark, sf_dir), writer, f"{root}/checkpoint")
    return progress.current().drop("run")


@query(f"""{_EVENT_DELIVERY} SELECT d.consumer AS consumer_id, d.topic, m.partition, d.pos AS "offset", reason,
  CASE WHEN reason IS NULL THEN sha256(m.props) END AS payload_checksum FROM decisions d JOIN messages m ON m.pos = d.pos""")
def resumed_federation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drains over a table that grows in between give what one batch gives."""
    root = scratch_path(spark, "resumed")
    events = views.table(spark, sf_dir, "events")
    grants = Refreshed(lambda: views.event_grants(spark))
    for half in (0, 1):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).write.mode("append").parquet(f"{root}/events")
        stream = views.as_event_messages(spark.readStream.schema(events.schema).parquet(f"{root}/events"))
        streams.run_federation(stream, grants, f"{root}/sink", f"{root}/checkpoint").awaitTermination()
    return streams.read_sink(spark, f"{root}/sink").select(
        "consumer_id", "topic", "partition", "offset", "reason", "payload_checksum"
    )


def _inbound(spark: SparkSession, sf_dir: str, action: str, times: int) -> DataFrame:
    """Envelopes received ``times`` times over, in several micro-batches, verified and stored."""
    root = scratch_path(spark, "inbound")
    envelopes = views.envelopes(spark, sf_dir)
    progress = ProgressTable(spark, f"{root}/progress")
    writer = streams.inbound_writer(
        f"{root}/sink", client="c", server="s", on_mismatch=action, progress=progress, exact=times > 1
    )
    for _ in range(times):
        # Offsets arrive in no order.
        each = _feed(envelopes, f"{root}/envelopes", F.xxhash64("offset"), F.octet_length("value"), files=3, each=2)
        stream = spark.readStream.schema(envelopes.schema).option("maxFilesPerTrigger", each).parquet(f"{root}/envelopes")
        streams.drain(stream, writer, f"{root}/checkpoint")
    stored = streams.read_sink(spark, f"{root}/sink")
    return stored.select("topic", "offset", "checksum_status", "skipped")


@query(f"""WITH {_ENVELOPES} SELECT topic, pos AS "offset", status AS checksum_status, status = 'FAIL' AS skipped FROM envelopes""")
def drained_inbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inbound(spark, sf_dir, "SKIP", 1)


@query(f"""WITH {_ENVELOPES} SELECT topic, pos AS "offset", status AS checksum_status, false AS skipped FROM envelopes""")
def redelivered_inbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything is delivered twice and stored once."""
    return _inbound(spark, sf_dir, "LOG_ONLY", 2)


@query(f"""WITH {_REFERENCES} SELECT k AS file_sequence_id, source AS topic, reason, NULL::VARCHAR AS checksum FROM checked
    WHERE reason IS NOT NULL
  UNION ALL SELECT k, c.source, CASE WHEN k % 7 = 0 THEN 'FETCH' END, CASE WHEN k % 7 <> 0 THEN sha256(text) END
    FROM checked c JOIN documents ON doc_id = k WHERE reason IS NULL""")
def drained_file_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File references as a stream: chunks of those that can be read, rejects of the others; the stream goes on."""
    root = scratch_path(spark, "file-requests")
    written(views.file_reference_messages(spark, sf_dir), f"{root}/references")
    given = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id"), F.when(F.col("doc_id") % 7 != 0, F.encode("text", "UTF-8")).alias("content")
    )

    def contents(valid: DataFrame) -> DataFrame:
        named = valid.select("uri", F.regexp_extract("uri", r"(\d+)[.]txt$", 1).try_cast("bigint").alias("doc_id")).distinct()
        return named.join(given, "doc_id").select("uri", "content", F.lit(None).cast("string").alias("error"))

    writer = streams.file_outbound_writer(
        contents,
        f"{root}/chunks",
        f"{root}/rejects",
        listing=lambda requests: views.file_listing(spark, sf_dir),
        chunk_size=1000,
        azure_account="acct",
    )
    references = spark.read.parquet(f"{root}/references")
    stream = spark.readStream.schema(references.schema).parquet(f"{root}/references")
    streams.drain(stream, writer, f"{root}/checkpoint")
    built = files.assemble_files(streams.read_sink(spark, f"{root}/chunks"), by=["topic", "partition"])
    rejects = streams.read_sink(spark, f"{root}/rejects")
    return rejects.select("file_sequence_id", "topic", "reason", F.lit(None).cast("string").alias("checksum")).union(
        built.select("file_sequence_id", "topic", F.lit(None).cast("string"), "actual_checksum")
    )


@query(f"""WITH {_FILES} SELECT k AS file_sequence_id, name AS file_name, total::BIGINT AS chunk_count,
  size AS actual_size, sha256(content) AS actual_checksum, sha256(content) AS file_checksum FROM sized""")
def reassembled_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "reassembled")
    named = views.files(spark, sf_dir).withColumns({"topic": F.lit("files"), "partition": F.lit(0)})
    chunks = files.chunk_files(named, 1000, by=["topic", "partition"])
    # Chunks of a file come in no order, in several micro-batches.
    place = F.xxhash64("file_sequence_id", "chunk_index")
    each = _feed(chunks, f"{root}/chunks", place, F.coalesce(F.octet_length("chunk_data"), F.lit(0)) + 100, files=8, each=4)
    stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", each).parquet(f"{root}/chunks")
    streams.drain(stream, intake_writer(f"{root}/intake", block_chunks=16), f"{root}/checkpoint")
    return files.file_facts(Intake(spark, f"{root}/intake").blocks(), by=["topic", "partition"]).select(
        "file_sequence_id", "file_name", "chunk_count", "actual_size", "actual_checksum", "file_checksum"
    )


@query(f"""WITH {_RECEIVED}, good AS (SELECT k, content, 'p' || (k // 50) AS run FROM received
    WHERE k % 89 <> 0 AND NOT (k % 97 = 0 AND size > 0)),
  failed AS (SELECT 'p' || (k // 50) AS run, min(k) AS at FROM received WHERE k % 89 <> 0 AND k % 97 = 0 AND size > 0 GROUP BY 1),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY k) AS rn, count(*) OVER (PARTITION BY run) AS n
    FROM good)
  SELECT g.k AS file_sequence_id, 'in/' || g.run || CASE WHEN n > 1 THEN '-v' || (10 + rn) ELSE '' END || '.txt' AS name,
    sha256(content) AS checksum FROM numbered g LEFT JOIN failed f ON f.run = g.run WHERE f.at IS NULL OR g.k < f.at""")
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receive, verify, store and publish files, then read the published ones back."""
    root = scratch_path(spark, "landed")
    run = F.concat(F.lit("p"), F.floor(F.col("file_sequence_id") / 50).cast("string"))
    chunks = written(_received(spark, sf_dir).withColumn("run", run), f"{root}/chunks")
    runs = chunks.select("run").distinct()
    destinations = runs.withColumn("destination", F.concat(F.lit("in/"), "run", F.lit(".txt")))
    counters = runs.select(F.col("run").alias("product_key"), F.lit(10).cast("bigint").alias("counter"))
    store = f"{root}/store" if "://" in root or root.startswith("file:") else f"file:{root}/store"
    landing = land_files(chunks, destinations, counters, store, f"{root}/work", block_chunks=8)
    # Digests are taken where files are read: bytes are not shuffled, and neither side is collected by the driver.
    back = read_files(stat_files(landing.published.where("ok"))).select("uri", F.sha2("content", 256).alias("checksum"))
    return shuffled_join(landing.published, back, ["uri"]).select(
        "file_sequence_id",
        F.substring_index("uri", "/store/", -1).alias("name"),
        "checksum",
    )


_PARTITIONED = f"""{_RECEIVED}, placed AS (SELECT r.*, lang || '-' || (doc_id // 60) AS run, source AS topic,
    (k % 3)::INT AS "partition", k // 3 AS seq, k % 97 = 0 AND size > 0 AS bad
    FROM received r JOIN documents ON doc_id = k % 1000000000),
  good AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY seq, topic, "partition") AS rn, count(*) OVER (PARTITION BY run) AS n
    FROM placed WHERE k % 89 <> 0 AND NOT bad),
  failed AS (SELECT run, min((seq, topic, "partition")) AS stop FROM placed WHERE k % 89 <> 0 AND bad GROUP BY run),
  out AS (SELECT g.* FROM good g LEFT JOIN failed f ON f.run = g.run WHERE stop IS NULL OR (seq, topic, "partition") < stop)"""


def _partitioned_landing(spark: SparkSession, sf_dir: str) -> Landing:
    """Files of several topics and partitions, whose offsets repeat, with one name; the attempt is repeated once."""
    root = scratch_path(spark, "partitions")
    key = F.col("file_sequence_id")
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    placed = _received(spark, sf_dir).join(docs, F.col("doc_id") == key % 1_000_000_000)
    chunks = placed.select(
        F.concat("lang", F.lit("-"), F.floor(F.col("doc_id") / 60).cast("string")).alias("run"),
        F.col("source").alias("topic"),
        (key % 3).cast("int").alias("partition"),
        F.floor(key / 3).alias("file_sequence_id"),
        F.lit("same.txt").alias("file_name"),
        *[c for c in placed.columns if c not in ("file_sequence_id", "file_name", *docs.columns)],
    )
    chunks = written(chunks, f"{root}/chunks")
    runs = chunks.select("run").distinct()
    destinations = runs.withColumn("destination", F.concat(F.lit("in/"), "run", F.lit(".txt")))
    counters = runs.select(F.col("run").alias("product_key"), F.lit(10).cast("bigint").alias("counter"))
    store = f"{root}/store" if "://" in root or root.startswith("file:") else f"file:{root}/store"
    land_files(chunks, destinations, counters, store, f"{root}/work", block_chunks=8)
    moved_on = counters.withColumn("counter", F.col("counter") + 7)
    return land_files(chunks, destinations, moved_on, store, f"{root}/work", block_chunks=8)


@query(f"""WITH {_PARTITIONED} SELECT run, topic, "partition", seq AS file_sequence_id,
  'in/' || run || CASE WHEN n > 1 THEN '-v' || (10 + rn) ELSE '' END || '.txt' AS name, sha256(content) AS checksum FROM out""")
def landed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal offsets and equal names in several partitions, landed by an attempt that is repeated: one result a file."""
    published = _partitioned_landing(spark, sf_dir).published
    back = read_files(stat_files(published.where("ok")))
    return published.join(back, "uri").select(
        "run",
        "topic",
        "partition",
        "file_sequence_id",
        F.substring_index("uri", "/store/", -1).alias("name"),
        F.sha2("content", 256).alias("checksum"),
    )


@query(f"""WITH {_PARTITIONED}, seen AS (SELECT p.run, p.topic, p."partition", p.seq, o.k IS NOT NULL AS done FROM placed p
    LEFT JOIN out o ON o.k = p.k WHERE p.k % 89 <> 0 OR p.arrived > 0)
  SELECT run, topic, "partition", least(max(seq) FILTER (done) + 1, min(seq) FILTER (NOT done)) AS next_sequence_id
  FROM seen GROUP BY ALL""")
def landed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every partition is read on after that."""
    return _partitioned_landing(spark, sf_dir).progress


_GRANTED = """WITH m AS (SELECT doc_id, 't' || (doc_id % (SELECT count(*) FROM supplier) + 1) AS topic, doc_id % 29 = 0 AS bad,
    CASE doc_id % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'F' END AS ls, CASE doc_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' END AS rf,
    text FROM documents),
  g AS (SELECT 't' || l_suppkey AS topic, 'c' || o_custkey AS consumer_id,
    list(DISTINCT l_linestatus) FILTER (l_linenumber >= 2) AS ls, list(DISTINCT l_returnflag) FILTER (l_linenumber > 2) AS rf
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
  sent AS (SELECT consumer_id, m.* FROM m JOIN g ON g.topic = m.topic WHERE coalesce(len(g.ls), 0) + coalesce(len(g.rf), 0) = 0
    OR (NOT bad AND (g.ls IS NULL OR g.ls = [m.ls]) AND (g.rf IS NULL OR g.rf = [m.rf])))"""


@query(f"""{_GRANTED} SELECT consumer_id, topic, count(*) AS messages FROM sent GROUP BY ALL""")
def federate_granted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to the consumers of a grants table of one row per order line and attribute, judged by class."""
    routed = views.granted_messages(spark, sf_dir).drop("value")
    return federation.delivered_counts(federate_classes(routed, views.grant_rows(spark, sf_dir)))


@query(f"""{_GRANTED} SELECT topic, doc_id AS "offset", sha256(text) AS payload_checksum, count(*) AS consumers,
  min(consumer_id) AS first_consumer FROM sent GROUP BY ALL""")
def federate_granted_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message that anyone gets, shaped and digested once, with its consumers counted."""
    sent = federate_classes(views.granted_messages(spark, sf_dir), views.grant_rows(spark, sf_dir), shape=messages.to_envelope)
    return sent.groupBy("topic", "offset", "payload_checksum").agg(
        F.count(F.lit(1)).alias("consumers"), F.min("consumer_id").alias("first_consumer")
    )


_RUNS = "event_id * 40 // (SELECT max(event_id) + 1 FROM events)"


def _event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as 40 small runs of one client, written so that each run is read on its own."""
    rows = views.event_messages(spark, sf_dir).select("topic", "partition", "offset")
    end = rows.agg(F.max("offset") + 1).first()[0] or 1
    run = F.expr(f"offset * 40 div {end}").alias("run")
    path = scratch_path(spark, "runs")
    rows.select(F.lit("c").alias("client"), F.lit("s").alias("server"), "*", run).write.partitionBy("run").parquet(path)
    return spark.read.parquet(path)


@query(f"""WITH runs AS (SELECT event_type AS topic, (user_id % 4)::INT AS partition, {_RUNS} AS run, max(event_id) + 1 AS n
    FROM events GROUP BY ALL)
  SELECT 'c' AS client, 's' AS server, topic, partition, arg_max(n, run) AS next_offset, max(run) AS run
  FROM runs GROUP BY topic, partition""")
def compacted_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of many small batches, folded into snapshots on the way."""
    runs = _event_runs(spark, sf_dir)
    progress = ProgressTable(spark, scratch_path(spark, "progress"), every=8)
    for run in range(40):
        progress.commit(messages.next_offsets(runs.where(F.col("run") == run)), run)
    return progress.current()


@query("""WITH seen AS (SELECT DISTINCT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS p FROM events),
  islands AS (SELECT *, p - row_number() OVER (PARTITION BY topic, partition ORDER BY p) AS i FROM seen)
  SELECT 'c' AS client, 's' AS server, topic, partition, min(p) AS first, max(p) AS last FROM islands GROUP BY topic, partition, i""")
def delivered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered positions as ranges: batches hold late offsets and repeat some of the batch before."""
    runs = _event_runs(spark, sf_dir)
    delivered = DeliveredTable(spark, scratch_path(spark, "delivered"), every=5)
    for batch in range(20):
        late = F.col("run").isin((batch * 7) % 20, (batch * 7) % 20 + 20, (batch * 7 - 7) % 20)
        delivered.commit(runs.where(late), batch)
    return delivered.ranges()


class _Ended(Exception):
    """A driver that goes away."""


def _ended(writer: streams.BatchWriter, batch: int, *, before: bool) -> streams.BatchWriter:
    """A writer whose driver ends in a batch, ``before`` its commit (with files written) or right after it."""

    def write(rows: DataFrame, number: int) -> None:
        if number == batch and before:
            last = rows.agg(F.max("offset")).first()[0]
            late = F.when(F.col("offset") == last, F.raise_error(F.lit("ended")).cast("binary")).otherwise(F.col("value"))
            writer(rows.withColumn("value", late), number)
        writer(rows, number)
        if number == batch:
            raise _Ended(str(batch))

    return write


def _drain_until_ended(stream: DataFrame, writer: streams.BatchWriter, checkpoint: str) -> None:
    try:
        streams.drain(stream, writer, checkpoint)
    except Exception as problem:
        if "ended" not in str(problem) and "_Ended" not in str(problem):
            raise


@query(f"""{_EVENT_DELIVERY} SELECT CASE WHEN reason IS NULL THEN 'delivered' ELSE 'dead-letter' END AS kind, d.consumer AS consumer_id,
  'hub-' || d.topic AS topic, m.partition, d.pos AS "offset", 'Dead-Letter-Reason=' || reason AS letter,
  CASE WHEN reason IS NULL THEN sha256(m.props) END AS payload_checksum FROM decisions d JOIN messages m ON m.pos = d.pos""")
def exchanged_federation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into the exchange sink whose driver ends in mid-batch, before and after a commit: no row twice, none lost."""
    root = scratch_path(spark, "exchange")
    sink = f"{root}/sink" if "://" in root or root.startswith("file:") else f"file:{root}/sink"
    events = views.table(spark, sf_dir, "events")
    size = F.octet_length("props") + 50
    each = _feed(events, f"{root}/events", F.col("event_id"), size, files=4, each=1)
    stream = views.as_event_messages(
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", each).parquet(f"{root}/events")
    )
    writer = streams.exchange_writer(views.event_grants(spark), sink, server="hub")
    for ended in (_ended(writer, 1, before=True), _ended(writer, 2, before=False), writer):
        _drain_until_ended(stream, ended, f"{root}/checkpoint")
    last = F.element_at("headers", -1)
    letter = F.when(last["key"] == "Dead-Letter-Reason", F.concat_ws("=", last["key"], last["value"]))
    parts = [
        read_exchange(spark, sink, kind).select(
            F.lit(kind).alias("kind"), "consumer_id", "topic", "partition", "offset", letter.alias("letter"), "payload_checksum"
        )
        for kind in (DELIVERED, DEAD_LETTER)
    ]
    return parts[0].union(parts[1])


_VERSIONED = " UNION ALL ".join(
    f"""SELECT * FROM ({_event_delivery(policy)} SELECT d.consumer AS consumer_id, d.topic, m.partition, d.pos AS "offset", reason
    FROM decisions d JOIN messages m ON m.pos = d.pos WHERE d.pos % 3 {part})"""
    for policy, part in ((views.EVENT_POLICY, "< 2"), (views.LATER_POLICY, "= 2"))
)


@query(_VERSIONED)
def federated_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grants that change in mid-stream: a batch that is attempted again after the change goes by what it was planned with."""
    root = scratch_path(spark, "versions")
    events = views.table(spark, sf_dir, "events")
    grants = VersionedTable(spark, f"{root}/grants")
    writer = streams.outbound_writer(grants, f"{root}/sink", server="hub")
    for batch in range(3):
        events.where(F.col("event_id") % 3 == batch).write.mode("append").parquet(f"{root}/events")
        stream = views.as_event_messages(spark.readStream.schema(events.schema).parquet(f"{root}/events"))
        if batch == 0:
            grants.publish(views.event_grants(spark))
        if batch == 1:
            _drain_until_ended(stream, _ended(writer, 1, before=False), f"{root}/checkpoint")
            grants.publish(views.event_grants(spark, views.LATER_POLICY))
        streams.drain(stream, writer, f"{root}/checkpoint")
    return streams.read_sink(spark, f"{root}/sink").select("consumer_id", "topic", "partition", "offset", "reason")


# --- sources and hooks -------------------------------------------------------------------------------------------


@query("""WITH m AS (SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS pos, props FROM events),
  ends AS (SELECT max(event_id) + 1 AS n FROM events),
  begun AS (SELECT m.*, row_number() OVER (PARTITION BY topic, partition ORDER BY pos) AS r FROM m, ends
    WHERE partition < 3 AND pos >= CASE partition WHEN 0 THEN 0 WHEN 1 THEN n // 2 ELSE n - n // 8 END)
  SELECT topic, partition, pos AS "offset", props AS value FROM begun WHERE r <= 50""")
def bounded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 50 messages of each partition from its own start on, out of those files of a message table that hold them."""
    root = scratch_path(spark, "bounded")
    views.event_messages(spark, sf_dir).repartitionByRange(16, "offset").write.parquet(f"{root}/messages")
    index = message_source.index_messages(spark.read.parquet(f"{root}/messages"))
    n = index.agg(F.max("last") + 1).first()[0] or 0
    begin = F.when(F.col("partition") == 0, message_source.EARLIEST).when(F.col("partition") == 1, n // 2)
    begin = begin.when(F.col("partition") == 2, n - n // 8).otherwise(message_source.LATEST)
    starts = index.select("topic", "partition").distinct().withColumn("offset", begin.cast("bigint"))
    found = message_source.read_from(spark, index, starts, max_records=50)
    return found.select("topic", "partition", "offset", F.decode("value", "UTF-8").alias("value"))


@query("""SELECT event_type AS topic, (user_id % 4)::INT AS partition, event_id AS "offset" FROM events
  WHERE event_type IN ('click', 'view') AND (event_type <> 'click' OR user_id % 4 <> 1 OR event_id >= 500)
    AND (event_type <> 'view' OR user_id % 4 <> 2)""")
def read_messages_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of messages with starts by topic and partition."""
    path = scratch_path(spark, "messages")
    views.event_messages(spark, sf_dir).write.parquet(path)
    start = {"click": {"1": 500, "0": message_source.EARLIEST}, "view": {"2": message_source.LATEST}}
    found = message_source.read_messages(spark, path, ["click", "view"], start=start, format="parquet")
    return found.select("topic", "partition", "offset")


@query(f"WITH {_FEEDS} SELECT * EXCLUDE (c) FROM feeds")
def feeds_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of consumer documents that are read from files."""
    path = scratch_path(spark, "documents")
    views.consumer_documents(spark, sf_dir).write.json(path)
    found = feeds.feeds(read_feeds_config(spark, path, multi_line=False), "node-1")
    return found.select(
        *feeds.FEED_COLUMNS,
        F.col("effective_schedule.schedule_type").alias("effective_type"),
        F.col("effective_schedule.schedule_expression").alias("effective_expression"),
    )


@query(f"""WITH {MESSAGES} SELECT topic, pos AS "offset", text || chr(10) || topic AS value, sha256(text || chr(10) || topic) AS payload_checksum
  FROM messages""")
def envelope_of_own_handler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload handler of the caller's own, applied before the digest, behind a processor that marks each message."""

    def marked(rows: DataFrame) -> DataFrame:
        mark = F.struct(F.lit("mark").alias("key"), F.col("topic").alias("value"))
        return rows.withColumn("headers", F.array_append("headers", mark))

    def handler(value: Column, headers: Column) -> Column:
        last = F.element_at(headers, -1)
        return F.concat(value, F.encode(F.concat(F.lit("\n"), last["value"]), "UTF-8"))

    shaped = messages.to_envelope(views.messages(spark, sf_dir).transform(marked), payload=handler)
    return shaped.select("topic", "offset", F.decode("value", "UTF-8").alias("value"), "payload_checksum")


@query(f"""{_EVENT_DELIVERY} SELECT d.consumer AS consumer_id, d.topic, d.pos AS "offset" FROM decisions d
  WHERE reason IS NULL AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.pos = d.pos AND e.k = 'HOME' AND e.v = '4')""")
def federate_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule of the caller's own beside the attributes."""

    def elsewhere(look: Callable[[str], Column], attributes: Column) -> Column:
        return F.coalesce(look("home") != "4", F.lit(True))

    rows = views.event_messages(spark, sf_dir).drop("value")
    sent = federation.federate(rows, views.event_grants(spark), predicate=elsewhere)
    return sent.select("consumer_id", "topic", "offset")
