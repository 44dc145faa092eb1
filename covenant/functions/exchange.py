"""Who sent a message and what it describes, resolved from its shared headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covenant.functions.headers import SECURITY_LABEL
from covenant.functions.labels import label_value, parse_label
from covenant.functions.text import bind, is_blank, trim_all

# Metadata fields, as direct headers or as keys of a JSON header, and the label's organisation keys.
FIELDS = {"org_name": "orgName", "schema_type": "schemaType", "product_type": "productType"}
ORGANISATION_KEYS = ("ORGANISATION_TYPE", "ORGANISATION")


def exchange_metadata(headers: Column, server: Column) -> Column:
    """``struct(org_name, schema_type, product_type)``.

    Headers are read in order up to the first JSON header naming a field; its values win over direct headers before
    it, the last direct header of a name wins over earlier ones, and headers after it are not read. Without an
    organisation the first well-formed security label decides, then the server name.
    """
    filled = F.filter(headers, lambda h: ~is_blank(h["value"]))
    direct_names = [name.lower() for name in FIELDS.values()]

    def json_names_field(header: Column) -> Column:
        names = F.array(*[F.lit(n) for n in FIELDS.values()])
        is_json = ~F.lower(header["key"]).isin(direct_names) & trim_all(header["value"]).startswith("{")
        return F.coalesce(is_json & F.arrays_overlap(F.json_object_keys(header["value"]), names), F.lit(False))

    def resolve(pair: Column) -> Column:
        scanned, hits = pair["filled"], pair["hits"]
        stop = F.array_position(hits, F.lit(True)).cast("int")
        read = F.when(stop > 0, F.slice(scanned, F.lit(1), stop)).otherwise(scanned)
        json_text = F.when(stop > 0, F.get(scanned, stop - 1)["value"])

        def field(name: str) -> Column:
            matches = F.filter(read, lambda h: F.lower(h["key"]) == name.lower())
            direct = F.try_element_at(matches, F.lit(-1))["value"]
            return F.coalesce(trim_all(F.get_json_object(json_text, f"$.{name}")), trim_all(direct))

        return F.struct(*[field(name).alias(alias) for alias, name in FIELDS.items()])

    found = bind(
        F.struct(filled.alias("filled"), F.transform(filled, json_names_field).alias("hits")),
        resolve,
    )

    def label_org(header: Column) -> Column:
        return bind(
            parse_label(header["value"]),
            lambda label: F.coalesce(*[label_value(label["entries"], F.lit(k)) for k in ORGANISATION_KEYS]),
        )

    labels = F.filter(headers, lambda h: F.lower(h["key"]) == SECURITY_LABEL.lower())
    from_label = F.get(F.filter(F.transform(labels, label_org), lambda o: o.isNotNull()), F.lit(0))

    return bind(
        found,
        lambda f: F.struct(
            F.coalesce(f["org_name"], from_label, server).alias("org_name"),
            f["schema_type"].alias("schema_type"),
            f["product_type"].alias("product_type"),
        ),
    )
