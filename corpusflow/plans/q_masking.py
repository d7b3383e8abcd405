"""Registered masking queries (M1-M8, G10) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import pii
from corpusflow.operators.masking import apply_field_security, mask_documents, mask_text_df
from corpusflow.plans import fixtures as fx
from corpusflow.plans.registry import register

SQL_PII = """pii AS (
  SELECT doc_id, text || ' call 555-' || lpad((doc_id % 1000)::VARCHAR, 3, '0') || '-'
         || lpad((doc_id % 10000)::VARCHAR, 4, '0') || ' ssn ' || lpad((doc_id % 1000)::VARCHAR, 3, '0')
         || '-' || lpad((doc_id % 100)::VARCHAR, 2, '0') || '-' || lpad((doc_id % 10000)::VARCHAR, 4, '0')
         || ' iban DE' || lpad((doc_id % 100)::VARCHAR, 2, '0') || lpad(doc_id::VARCHAR, 18, '0') AS text
  FROM documents)"""

# RE2 (the oracle's engine) has no look-ahead: the SSN shape is matched
# without it and the excluded number ranges are tested afterwards.
SQL_PAT = {
    "EMAIL_ADDRESS": pii.EMAIL,
    "PHONE_NUMBER": pii.PHONE,
    "CREDIT_CARD": pii.CARD,
    "US_SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "IBAN_CODE": pii.IBAN,
}


def sql_valid(et: str, h: str) -> str:
    if et == "US_SSN":
        return (f"(substr({h}, 1, 3) NOT IN ('000', '666') AND substr({h}, 1, 1) <> '9' "
                f"AND substr({h}, 5, 2) <> '00' AND substr({h}, 8, 4) <> '0000')")
    return "TRUE"


def sql_mask(et: str, h: str) -> str:
    if et == "EMAIL_ADDRESS":
        return f"repeat('*', length(split_part({h}, '@', 1))) || '@' || split_part({h}, '@', 2)"
    if et == "PHONE_NUMBER":
        d = f"regexp_replace({h}, '\\D', '', 'g')"
        return (f"CASE WHEN length({d}) > 4 THEN repeat('*', length({d}) - 4) || right({d}, 4) "
                f"ELSE repeat('*', length({d})) END")
    return (f"CASE WHEN {sql_valid(et, h)} THEN repeat('*', length({h})) ELSE {h} END")


def sql_mask_chain(src: str, entities=None) -> str:
    """CTEs m0..m5 over ``src(doc_id, text)``; m5 has (doc_id, t, found)."""
    ctes = [f"m0 AS (SELECT doc_id, text AS t, []::VARCHAR[] AS found FROM {src})"]
    ets = [e for e in pii.ENTITY_TYPES if entities is None or e in entities]
    for n, et in enumerate(ets, 1):
        pat = SQL_PAT[et]
        off = ("coalesce(list_sum(list_transform(pcs[1:i], lambda x: length(x))), 0) + "
               "coalesce(list_sum(list_transform(hts[1:i - 1], lambda x: length(x))), 0)")
        ctes.append(f"""s{n} AS (SELECT doc_id, t, found, regexp_split_to_array(t, '{pat}') AS pcs,
                 regexp_extract_all(t, '{pat}') AS hts FROM m{n - 1})""")
        ctes.append(f"""m{n} AS (SELECT doc_id,
    array_to_string(list_transform(range(1, len(pcs) + 1),
        lambda i: pcs[i] || coalesce(CASE WHEN i <= len(hts) THEN {sql_mask(et, 'hts[i]')} END, '')), '') AS t,
    list_concat(found, list_filter(list_transform(range(1, len(hts) + 1),
        lambda i: CASE WHEN {sql_valid(et, 'hts[i]')} THEN '{et}:' || ({off})::VARCHAR || '-'
                  || ({off} + length(hts[i]))::VARCHAR END), lambda x: x IS NOT NULL)) AS found
  FROM s{n})""")
    return ",\n".join(ctes), f"m{len(ets)}"


def findings_str(found):
    return F.concat_ws(";", F.transform(found, lambda f: F.concat(
        f["type"], F.lit(":"), f["start"].cast("string"), F.lit("-"), f["end"].cast("string"))))


# ------------------------------------------------------------ finders M1-M5
def _finder(et: str, name: str):
    sql = f"""WITH {SQL_PII},
h AS (SELECT doc_id, list_filter(regexp_extract_all(text, '{SQL_PAT[et]}'), lambda x: {sql_valid(et, 'x')}) AS hs FROM pii)
SELECT doc_id, (i - 1)::BIGINT AS hit_index, hs[i] AS hit
FROM (SELECT doc_id, hs, unnest(range(1, len(hs) + 1)) AS i FROM h)"""

    @register(name, sql)
    def q(spark, sf_dir):
        d = fx.pii_documents(spark, sf_dir)
        return d.select("doc_id", F.posexplode(pii.find_all(F.col("text"), et)).alias("hit_index", "hit")) \
                .select("doc_id", F.col("hit_index").cast("long").alias("hit_index"), "hit")
    q.__doc__ = f"{et} finder over documents with injected PII (one row per match)."
    return q


q_mask_email = _finder("EMAIL_ADDRESS", "mask_email")
q_mask_phone = _finder("PHONE_NUMBER", "mask_phone")
q_mask_card = _finder("CREDIT_CARD", "mask_card")
q_mask_ssn = _finder("US_SSN", "mask_ssn")
q_mask_iban = _finder("IBAN_CODE", "mask_iban")


# ------------------------------------------------------------- M6 mask_text
_chain, _last = sql_mask_chain("pii")
SQL_MASK_TEXT = f"""WITH {SQL_PII},
{_chain}
SELECT doc_id, t AS masked_text, len(found)::BIGINT AS n_entities, array_to_string(found, ';') AS entities
FROM {_last}"""


@register("mask_text", SQL_MASK_TEXT)
def q_mask_text(spark, sf_dir):
    """M6: position-exact chained masking of whole documents; findings with
    offsets into the text at the start of each type's pass."""
    d = mask_text_df(fx.pii_documents(spark, sf_dir), "text", out_col="masked_text", findings_col="f")
    return d.select(
        "doc_id", "masked_text", F.size("f").cast("long").alias("n_entities"),
        findings_str(F.col("f")).alias("entities"))


# --------------------------------------------------------- M7 mask_document
SQL_MASK_DOC = f"""WITH {SQL_PII},
{_chain}
SELECT doc_id, t AS content, TRUE AS pii_masked, len(found)::BIGINT AS pii_entities_count,
       'regex' AS masking_method,
       array_to_string(list_transform(found, lambda x: split_part(x, ':', 1)), ',') AS pii_entity_types,
       (len(found) * 1.0)::DOUBLE AS pii_score_sum
FROM {_last}"""


@register("mask_document", SQL_MASK_DOC)
def q_mask_document(spark, sf_dir):
    """M7: masked document rows with masking metadata."""
    d = fx.pii_documents(spark, sf_dir).withColumnRenamed("text", "content")
    m = mask_documents(d)
    return m.select(
        "doc_id", "content", "pii_masked", "pii_entities_count", "masking_method",
        F.concat_ws(",", F.transform("pii_entities", lambda e: e["type"])).alias("pii_entity_types"),
        F.aggregate("pii_entities", F.lit(0.0), lambda a, e: a + e["score"]).alias("pii_score_sum"))


# ------------------------------------------------------------ M8 mask_field
FIELD_TYPES = {"email": "email", "phone": "phone", "ssn": "ssn", "credit_card": "credit_card",
               "bank_account": "bank_account", "name": "name"}

SQL_CUST = """cf AS (
  SELECT c_custkey,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         '(5' || lpad((c_custkey % 100)::VARCHAR, 2, '0') || ') ' || lpad((c_custkey % 1000)::VARCHAR, 3, '0')
             || '-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS phone,
         lpad((c_custkey % 1000)::VARCHAR, 3, '0') || '-' || lpad((c_custkey % 100)::VARCHAR, 2, '0') || '-'
             || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS ssn,
         '4' || lpad(c_custkey::VARCHAR, 15, '0') AS credit_card,
         'DE' || lpad(c_custkey::VARCHAR, 20, '0') AS bank_account,
         c_name AS name
  FROM customer)"""


def sql_mask_field(v: str, ft: str) -> str:
    d = f"regexp_replace({v}, '\\D', '', 'g')"
    if ft == "email":
        return (f"CASE WHEN instr({v}, '@') > 0 THEN repeat('*', instr({v}, '@') - 1) || '@' || "
                f"substr({v}, instr({v}, '@') + 1) ELSE repeat('*', length({v})) END")
    if ft == "phone":
        return f"CASE WHEN length({d}) > 4 THEN repeat('*', length({d}) - 4) || right({d}, 4) ELSE repeat('*', length({d})) END"
    if ft in ("ssn", "social_security"):
        return f"CASE WHEN length({d}) = 9 THEN '***-**-' || right({d}, 4) ELSE repeat('*', length({v})) END"
    if ft == "credit_card":
        return f"CASE WHEN length({d}) >= 13 THEN repeat('*', length({d}) - 4) || right({d}, 4) ELSE repeat('*', length({d})) END"
    return f"repeat('*', length({v}))"


SQL_MASK_FIELDS = f"""WITH {SQL_CUST}
SELECT c_custkey, {', '.join(f'{sql_mask_field(c, t)} AS {c}' for c, t in FIELD_TYPES.items())}
FROM cf"""


@register("mask_fields", SQL_MASK_FIELDS)
def q_mask_fields(spark, sf_dir):
    """M8: each customer-derived field masked by its type."""
    c = fx.customer_fields(spark, sf_dir)
    return c.select("c_custkey", *[pii.mask_field(F.col(n), t).alias(n) for n, t in FIELD_TYPES.items()])


SEC_ROLE = "warehouse_operator"
SEC_TYPES = {"email": "email", "phone": "phone", "ssn": "ssn", "credit_card": "credit_card",
             "bank_account": "bank_account"}
SQL_FIELD_SECURITY = f"""WITH {SQL_CUST}
SELECT c_custkey, {sql_mask_field('email', 'email')} AS email, phone, {sql_mask_field('ssn', 'ssn')} AS ssn,
       {sql_mask_field('credit_card', 'credit_card')} AS credit_card,
       {sql_mask_field('bank_account', 'bank_account')} AS bank_account, name
FROM cf"""


@register("field_security", SQL_FIELD_SECURITY)
def q_field_security(spark, sf_dir):
    """The customer fields as a warehouse operator may read them."""
    return apply_field_security(fx.customer_fields(spark, sf_dir), SEC_ROLE, SEC_TYPES)
