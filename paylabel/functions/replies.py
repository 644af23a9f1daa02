"""Parsing and gating of external-labeller replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: replies below this confidence are turned into "unknown".
CONFIDENCE_THRESHOLD = 0.8


def _snippet(text: Column) -> Column:
    """From the first ``{`` to the last ``}`` (empty when either is absent)."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def extract_json_reply(text: str | Column) -> Column:
    """Struct(parsed, has_label, label, confidence) of a reply text.

    The whole text is parsed first; when that fails, the span from the first
    ``{`` to the last ``}``.  ``has_label`` is true when the object has a
    ``label`` key (even if its value is null).
    """
    t = F.col(text) if isinstance(text, str) else text
    whole = F.try_parse_json(t)
    part = F.try_parse_json(_snippet(t))

    def parts(v: Column) -> Column:
        label_raw = F.try_variant_get(v, "$.label", "variant")
        return F.struct(
            v.isNotNull().alias("parsed"),
            label_raw.isNotNull().alias("has_label"),
            F.try_variant_get(v, "$.label", "string").alias("label"),
            F.coalesce(F.try_variant_get(v, "$.confidence", "double"), F.lit(0.0)).alias("confidence"),
        )

    # bound once, so that the text is parsed once and not for every part
    return F.get(F.transform(F.array(F.coalesce(whole, part)), parts), 0)


def confidence_gate(label: Column, confidence: Column, threshold: float = CONFIDENCE_THRESHOLD) -> Column:
    """Struct(success, label, confidence): low confidence -> ``unknown``."""
    conf = F.coalesce(confidence, F.lit(0.0))
    gated = F.when(conf < F.lit(threshold), F.lit("unknown")).otherwise(label)
    return F.struct(
        (gated.isNotNull() & (gated != F.lit("unknown"))).alias("success"),
        gated.alias("label"),
        conf.alias("confidence"),
    )
