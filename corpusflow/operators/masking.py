"""DataFrame-level masking operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions import pii


def mask_text_df(df: DataFrame, text_col: str = "text", entities: list[str] | None = None,
                 out_col: str = "masked_text", findings_col: str = "entities_found") -> DataFrame:
    """M6 as a DataFrame transform: adds the masked text and the findings
    (``type, start, end, original_length``)."""
    return pii.mask_text_columns(df, text_col, out_col, findings_col, entities)


def mask_documents(df: DataFrame, content_col: str = "content", entities: list[str] | None = None,
                   metadata_col: str | None = None) -> DataFrame:
    """M7: mask document content in place and record what was found.

    Struct content is rendered to JSON text first. Adds ``pii_masked``,
    ``pii_entities_count``, ``masking_method`` and ``pii_entities``
    (``type, score``; regex findings score 1.0) to ``metadata_col`` if given
    (a struct), else as top-level columns.
    """
    c = F.col(content_col)
    dtype = df.schema[content_col].dataType.typeName()
    text = F.to_json(c) if dtype in ("struct", "map", "array") else c.cast("string")
    tmp = pii.mask_text_columns(df.withColumn("__text", text), "__text", content_col, "__found",
                                entities).drop("__text")
    extra = {
        "pii_masked": F.lit(True),
        "pii_entities_count": F.size("__found").cast("long"),
        "masking_method": F.lit("regex"),
        "pii_entities": F.transform("__found", lambda f: F.struct(f["type"].alias("type"),
                                                                  F.lit(1.0).alias("score"))),
    }
    if metadata_col and metadata_col in df.columns:
        tmp = tmp.withColumn(metadata_col, F.col(metadata_col).withFields(**extra))
    else:
        tmp = tmp.withColumns(extra)
    return tmp.drop("__found")


# Which field types each reader role sees in clear. Fields of a
# type not listed for the role are masked with mask_field.
FIELD_POLICY = {
    "admin": {"email", "phone", "ssn", "credit_card", "bank_account"},
    "supply_chain_manager": {"email", "phone"},
    "warehouse_operator": {"phone"},
    "viewer": set(),
}


def apply_field_security(df: DataFrame, role: str, field_types: dict[str, str],
                         policy: dict[str, set[str]] | None = None) -> DataFrame:
    """Column-level security for one reader role.

    ``field_types`` maps column name -> field type (email, phone, ssn,
    credit_card, bank_account, ...). Columns whose type the role may not see
    are replaced by ``mask_field``; unknown roles see nothing in clear.
    """
    allowed = (policy or FIELD_POLICY).get(role, set())
    cols = {c: pii.mask_field(F.col(c).cast("string"), t)
            for c, t in field_types.items() if t not in allowed}
    return df.withColumns(cols) if cols else df
