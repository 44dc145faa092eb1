"""Line-based RDF statements (N-Triples and N-Quads) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covenant.functions.headers import CONTENT_TYPE, header_last_exact
from covenant.functions.text import bind, blank_to_null

# Content types.
N_QUADS = "application/n-quads"
N_TRIPLES = "application/n-triples"
PATCH_TYPES = ("application/rdf-patch", "application/rdf-patch+thrift")
# Other RDF syntaxes are passed through unchanged.
OTHER_SYNTAXES = (
    "text/turtle",
    "application/turtle",
    "application/trig",
    "text/trig",
    "application/ld+json",
    "application/rdf+xml",
    "application/rdf+json",
    "application/trix+xml",
    "application/rdf+thrift",
    "application/rdf+protobuf",
    "text/n3",
)

# The N-Quads terms. Repetitions are possessive, so long literals cannot exhaust the regex stack.
_ESCAPE = r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}"
_IRI = rf"""<(?:[^\x00-\x20<>"{{}}|^`\\]|{_ESCAPE})*+>"""
_BLANK = r"_:[\p{L}\p{N}_](?:[\p{L}\p{N}_.\-]*[\p{L}\p{N}_\-])?"
_LITERAL = (
    rf"""\"(?:[^"\\\n\r]|\\[tbnrf"'\\]|{_ESCAPE})*+\"(?:\^\^{_IRI}|@[A-Za-z]+(?:-[A-Za-z0-9]+)*+)?"""
)
_GAP = r"(?:\s|#[^\n\r]*+(?=[\n\r]|$))*+"
STATEMENT = (
    rf"{_GAP}({_IRI}|{_BLANK})\s*+({_IRI})\s*+({_IRI}|{_BLANK}|{_LITERAL})\s*+({_IRI}|{_BLANK})?\s*+\.{_GAP}"
)
_PLAIN_STRING = "^^<http://www.w3.org/2001/XMLSchema#string>"
_SEPARATOR = "\u0001"


def content_type(headers: Column) -> Column:
    """Last header of exactly this name; blank or absent means N-Quads."""
    return F.coalesce(blank_to_null(header_last_exact(headers, CONTENT_TYPE)), F.lit(N_QUADS))


def payload_kind(headers: Column) -> Column:
    """``patch`` for the two patch content types (any case), else ``dataset``."""
    return F.when(F.lower(content_type(headers)).isin(*PATCH_TYPES), "patch").otherwise("dataset")


def is_line_based(kind_of_content: Column) -> Column:
    """Whether the payload is read as statements; unknown content types are."""
    return ~F.lower(kind_of_content).isin(*PATCH_TYPES, *OTHER_SYNTAXES)


def statements(text: Column) -> Column:
    """Statement texts found from left to right, gaps and comments between them included."""
    return F.regexp_extract_all(text, F.lit(STATEMENT), F.lit(0))


def _may_start(text: Column) -> Column:
    """Cheap test that spares prose and other formats the statement search."""
    return text.rlike(r"\A\s*+(?:[<_#]|\z)")


def _packed(statement: Column) -> Column:
    """Subject, predicate, graph and object with a separator only literals could contain; the object comes last."""
    terms = F.regexp_replace(statement, STATEMENT, f"$1{_SEPARATOR}$2{_SEPARATOR}$4{_SEPARATOR}$3")
    return F.when(
        terms.endswith(_PLAIN_STRING), F.substring(terms, F.lit(1), F.length(terms) - len(_PLAIN_STRING))
    ).otherwise(terms)


def _packed_quads(text: Column, kind_of_content: Column) -> Column:
    """Distinct packed statements, or null when the text is not valid line-based RDF (graphs need N-Quads)."""

    def checked(found: Column) -> Column:
        covered = (F.array_join(found, "") == text) | ~text.rlike(r"\S")
        return F.when(covered, F.array_distinct(F.transform(found, _packed)))

    def graphs_allowed(packed: Column) -> Column:
        has_graph = F.exists(packed, lambda q: F.substring_index(q, _SEPARATOR, 3) != _without_graph(q))
        return F.when((F.lower(kind_of_content) != N_TRIPLES) | ~has_graph, packed)

    readable = is_line_based(kind_of_content) & _may_start(text)
    return F.when(readable, bind(bind(statements(text), checked), graphs_allowed))


def _without_graph(packed: Column) -> Column:
    return F.concat(F.substring_index(packed, _SEPARATOR, 2), F.lit(_SEPARATOR))


def _unpack(packed: Column) -> Column:
    return bind(
        F.split(packed, _SEPARATOR, 4),
        lambda t: F.struct(
            F.get(t, F.lit(0)).alias("subject"),
            F.get(t, F.lit(1)).alias("predicate"),
            F.get(t, F.lit(3)).alias("object"),
            F.when(F.get(t, F.lit(2)) != "", F.get(t, F.lit(2))).alias("graph"),
        ),
    )


def quads(text: Column, kind_of_content: Column) -> Column:
    """Distinct quads of a payload, or null when it is not valid line-based RDF."""
    return F.transform(_packed_quads(text, kind_of_content), _unpack)


def quad_line(q: Column) -> Column:
    return F.concat(F.concat_ws(" ", q["subject"], q["predicate"], q["object"], q["graph"]), F.lit(" .\n"))


def normalise_rdf(value: Column, headers: Column) -> Column:
    """Dataset payloads as sorted, distinct N-Quads lines; patches and anything unparsable stay byte for byte."""
    lines = F.array_sort(F.transform(quads(value.cast("string"), content_type(headers)), quad_line))
    return F.coalesce(F.array_join(lines, "").cast("binary"), value)
