"""The registered queries as SQL over the same tables, for the comparison with DuckDB."""

from __future__ import annotations


def rarity_sql(traits: str, base: str) -> str:
    """Common table expressions from ``traits`` and ``base`` to ``ranked``."""
    return f"""
    traits AS ({traits}),
    usable AS (SELECT * FROM traits WHERE token_id IS NOT NULL AND trait_type IS NOT NULL
               AND trait_value IS NOT NULL),
    base AS ({base}),
    freq AS (SELECT collection_id, trait_type, trait_value, count(*) AS trait_count
             FROM usable GROUP BY ALL),
    totals AS (SELECT collection_id, trait_type, CAST(sum(trait_count) AS BIGINT) AS total_trait_count,
                      count(*) AS n_values
               FROM freq GROUP BY ALL),
    scores AS (SELECT f.collection_id, f.trait_type, f.trait_value, f.trait_count, t.total_trait_count,
                      CASE WHEN t.total_trait_count = f.trait_count THEN 0
                           ELSE CAST(trunc(CAST(f.trait_count AS DOUBLE)
                                / (t.total_trait_count - f.trait_count) * 100) AS INTEGER)
                      END AS rarity_score
               FROM freq f JOIN totals t USING (collection_id, trait_type)),
    summed AS (SELECT u.collection_id, u.token_id, CAST(sum(s.rarity_score) AS INTEGER) AS rarity_score
               FROM usable u JOIN scores s USING (collection_id, trait_type, trait_value)
               GROUP BY ALL),
    filled AS (SELECT b.collection_id, b.token_id, coalesce(s.rarity_score, 0) AS rarity_score
               FROM (SELECT DISTINCT collection_id, token_id FROM base WHERE token_id IS NOT NULL) b
               LEFT JOIN summed s USING (collection_id, token_id)),
    ranked AS (SELECT collection_id, token_id, rarity_score,
                      CAST(row_number() OVER (PARTITION BY collection_id
                           ORDER BY rarity_score, token_id) AS INTEGER) AS "rank"
               FROM filled)"""


def _unpivot(source: str, collection: str, token: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({collection} AS VARCHAR) AS collection_id, CAST({token} AS VARCHAR) AS token_id,"
        f" '{kind}' AS trait_type, CAST({value} AS VARCHAR) AS trait_value FROM {source}"
        for kind, value in columns.items()
    )


_PART_TRAITS = _unpivot(
    "part",
    "p_type",
    "p_partkey",
    {
        kind: f"CASE WHEN p_brand <> 'Brand#13' THEN p_{kind} END"
        for kind in ("brand", "size", "name", "type")
    },
)
_PART_BASE = "SELECT p_type AS collection_id, CAST(p_partkey AS VARCHAR) AS token_id FROM part"
_PART = "WITH" + rarity_sql(_PART_TRAITS, _PART_BASE)

_DOCUMENT_TRAITS = _unpivot(
    "documents JOIN labels USING (doc_id)",
    "source",
    "doc_id",
    {"lang": "lang", "quality": "quality", "toxic": "toxic"},
)
_DOCUMENT_BASE = "SELECT source AS collection_id, CAST(doc_id AS VARCHAR) AS token_id FROM documents"

_EVENT_TRAITS = """SELECT event_type AS collection_id, CAST(user_id AS VARCHAR) AS token_id,
    'k' AS trait_type, nullif(regexp_extract(props, '"k": *([0-9]+)', 1), '0') AS trait_value FROM events"""

_LINES = "SELECT l_returnflag AS collection_id, CAST(l_partkey AS VARCHAR) AS token_id FROM lineitem"
_LINE_BASE = f"{_LINES} WHERE l_quantity > 45"
_LINE_RARITY = f"{_LINES} WHERE l_discount < 0.03"
_TOKEN_COUNTS = f"""SELECT 'base' AS table_name, count(*) AS n_rows,
    count(DISTINCT (collection_id, token_id)) AS n_tokens FROM ({_LINE_BASE})
    UNION ALL SELECT 'rarity', count(*), count(DISTINCT (collection_id, token_id)) FROM ({_LINE_RARITY})"""

_REGISTRY = """
    registry AS (SELECT CAST(s_suppkey + 1 AS INTEGER) AS id, 'name of ' || s_name AS collection_name,
        s_name AS contract_address,
        CASE WHEN s_nationkey < 3 THEN 'NOT_FETCHED' WHEN s_nationkey < 5 THEN 'FETCHING'
             WHEN s_nationkey < 7 THEN 'FETCHED' WHEN s_nationkey < 9 THEN 'METADATA_FETCHING'
             WHEN s_nationkey < 11 THEN 'METADATA_FETCHED' END AS status
    FROM supplier WHERE s_nationkey < 12)"""
_NEW_IDS = """CAST((SELECT coalesce(max(id), 0) FROM registry) + row_number() OVER (ORDER BY s_suppkey)
    AS INTEGER) AS id"""
_LABEL = "'collection_' || lower(substr(s_name, 1, 8))"

_OLD_RANKS = """SELECT CAST(o_orderkey AS VARCHAR) AS token_id,
    CAST(trunc(o_totalprice) AS INTEGER) AS rarity_score, CAST(o_custkey AS INTEGER) AS "rank",
    o_orderstatus AS collection_id FROM orders WHERE o_orderpriority <> '1-URGENT'"""
_NEW_RANKS = """SELECT CAST(o_orderkey AS VARCHAR) AS token_id,
    CAST(trunc(o_totalprice) AS INTEGER) + 7 AS rarity_score, CAST(o_custkey AS INTEGER) AS "rank",
    o_orderstatus AS collection_id FROM orders WHERE o_totalprice > 200000"""
_UPSERTED = f"""WITH old AS ({_OLD_RANKS}), new AS ({_NEW_RANKS})
    SELECT * FROM new UNION ALL SELECT * FROM old WHERE token_id NOT IN (SELECT token_id FROM new)"""

_BAD_BRANDS = "('Brand#7', 'Brand#8', 'Brand#9', 'Brand#10', 'Brand#11', 'Brand#12')"
_PART_DOCUMENT_PAIRS = f"""
    SELECT p_type, p_partkey, p_name, p_brand, 'brand' AS trait_type, p_brand AS trait_value FROM part
    UNION ALL SELECT p_type, p_partkey, p_name, p_brand, 'size',
        nullif(CAST(p_size - 1 AS VARCHAR), '0') FROM part
    UNION ALL SELECT p_type, p_partkey, p_name, p_brand, 'price', CAST(p_retailprice AS VARCHAR) FROM part
    UNION ALL SELECT p_type, p_partkey, p_name, p_brand, 'large',
        CASE WHEN p_size > 25 THEN 'True' END FROM part"""
_PART_DOCUMENT_TRAITS = f"""
    SELECT p_type AS collection_id, CAST(p_partkey AS VARCHAR) AS token_id, p_name AS name,
           trait_type, trait_value
    FROM ({_PART_DOCUMENT_PAIRS}) WHERE p_brand NOT IN {_BAD_BRANDS} AND p_brand <> 'Brand#13'
    UNION ALL
    SELECT p_type, CAST(p_partkey AS VARCHAR), p_name, NULL, NULL FROM part WHERE p_brand = 'Brand#13'"""
_LISTED_PART = "FROM part WHERE p_brand <> 'Brand#7'"
_LISTED_NAME = """CASE WHEN p_size <= 10 THEN p_name WHEN p_size <= 30 THEN p_brand
    ELSE p_type || ' ' || p_name END AS name"""

_ORACLE = {
    "rarity_part": f"{_PART} SELECT * FROM ranked",
    "rarity_documents": f"WITH {rarity_sql(_DOCUMENT_TRAITS, _DOCUMENT_BASE)} SELECT * FROM ranked",
    "rarity_events_json": f"WITH {rarity_sql(_EVENT_TRAITS, 'SELECT collection_id, token_id FROM traits')}"
    " SELECT * FROM ranked",
    "trait_frequency": f"{_PART} SELECT * FROM freq",
    "trait_totals": f"{_PART} SELECT * FROM totals",
    "trait_scores_join": f"{_PART} SELECT * FROM scores",
    "trait_scores_salted": f"{_PART} SELECT * FROM scores",
    "token_scores": f"{_PART} SELECT * FROM summed",
    "token_scores_split": f"{_PART} SELECT * FROM summed",
    "token_scores_filled": f"{_PART} SELECT * FROM filled",
    "token_rank": f"{_PART} SELECT * FROM ranked",
    "token_rank_ranged": f"{_PART} SELECT * FROM ranked",
    "top_common": f"""{_PART} SELECT *, CAST(row_number() OVER (ORDER BY rarity_score DESC, collection_id,
        token_id) AS INTEGER) AS position FROM ranked
        ORDER BY rarity_score DESC, collection_id, token_id LIMIT 10""",
    "top_rare": f"""{_PART} SELECT * FROM ranked WHERE collection_id = 'ECONOMY' ORDER BY "rank" LIMIT 20""",
    "top_k_per_collection": f'{_PART} SELECT * FROM ranked WHERE "rank" <= 20',
    "tokens_string_order": f"""SELECT *, CAST(row_number() OVER (ORDER BY token_id) AS INTEGER) AS position
        FROM ({_PART_BASE}) WHERE collection_id = 'ECONOMY' ORDER BY token_id LIMIT 10""",
    "tokens_numeric_order": """SELECT p_type AS collection_id, CAST(p_partkey AS VARCHAR) AS token_id,
        CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS INTEGER) AS position FROM part""",
    "rank_sorted": f'{_PART} SELECT *, "rank" AS position FROM ranked',
    "collection_report": f"""{_PART}, counted AS (SELECT collection_id, token_id, count(trait_value) AS n_traits
        FROM traits GROUP BY ALL)
        SELECT * FROM ranked JOIN counted USING (collection_id, token_id)
        WHERE collection_id IN ('ECONOMY', 'PROMO')""",
    "contract_report": """SELECT CAST(l_suppkey AS VARCHAR) AS collection_id,
        l_orderkey || '-' || l_linenumber AS token_id, CAST(trunc(l_quantity) AS INTEGER) AS rarity_score,
        l_linenumber AS "rank" FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        WHERE s_name = 'Supplier#000000001'""",
    "sample_side_by_side": f"""{_PART}, listed AS (SELECT 'base' AS side, token_id,
            CAST(row_number() OVER (ORDER BY token_id) AS INTEGER) AS position
            FROM base WHERE collection_id = 'PROMO')
        SELECT * FROM listed WHERE position <= 10
        UNION ALL SELECT 'rarity', token_id, "rank" FROM ranked
        WHERE collection_id = 'PROMO' AND "rank" <= 10""",
    "audit_missing": f"{_LINE_BASE} EXCEPT {_LINE_RARITY}",
    "audit_extra": f"{_LINE_RARITY} EXCEPT {_LINE_BASE}",
    "audit_summary": f"""WITH b AS (SELECT DISTINCT *, 1 AS b FROM ({_LINE_BASE})),
        r AS (SELECT DISTINCT *, 1 AS r FROM ({_LINE_RARITY})),
        m AS (SELECT DISTINCT *, 1 AS m FROM ({_LINES} WHERE l_linestatus = 'O'))
        SELECT collection_id, count(b) AS n_base, count(r) AS n_rarity,
               count(CASE WHEN r IS NULL THEN b END) AS n_missing,
               count(CASE WHEN b IS NULL THEN r END) AS n_extra,
               count(CASE WHEN m IS NULL THEN b END) AS n_without_metadata
        FROM b FULL JOIN r USING (collection_id, token_id) FULL JOIN m USING (collection_id, token_id)
        GROUP BY ALL""",
    "token_counts": _TOKEN_COUNTS,
    "observed_counts": _TOKEN_COUNTS,
    "unlabelled_documents": """SELECT 'documents' AS collection_id, CAST(doc_id AS VARCHAR) AS token_id
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "parse_token_id": """SELECT o_orderkey, CASE
        WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderkey AS VARCHAR)
        WHEN o_orderpriority = '2-HIGH'
            THEN CAST(CAST(o_orderkey AS HUGEINT) * 1208925819614629174706176 AS VARCHAR)
        WHEN o_orderpriority = '3-MEDIUM' THEN CAST(-o_orderkey AS VARCHAR)
        WHEN o_orderstatus NOT IN ('F', 'O') THEN CAST(o_orderkey AS VARCHAR) END AS token_id FROM orders""",
    "first_truthy": """SELECT p_partkey,
        CASE WHEN p_size <= 10 THEN '["' || p_name || '"]' WHEN p_size <= 30 THEN CAST(p_size AS VARCHAR)
             WHEN p_size <= 40 THEN 'True' ELSE '' END AS name,
        CASE WHEN p_size <= 10 THEN p_name ELSE p_brand END AS plain_name FROM part""",
    "stringify_or_null": """SELECT p_partkey, CASE
        WHEN p_size BETWEEN 6 AND 10 THEN '0' WHEN p_size BETWEEN 16 AND 20 THEN 'True'
        WHEN p_size BETWEEN 21 AND 25 THEN p_size || '.5' WHEN p_size BETWEEN 26 AND 30 THEN p_size || '00.0'
        WHEN p_size BETWEEN 36 AND 40 THEN '[1,' || p_size || ']' WHEN p_size > 45 THEN p_name
        END AS trait_value FROM part""",
    "collection_name": f"SELECT s_suppkey, {_LABEL} AS collection_name FROM supplier",
    "flatten_pages": f"""SELECT p_type AS collection_id, p_type AS collection_name, p_type AS contract_address,
        CAST(p_partkey AS VARCHAR) AS token_id, {_LISTED_NAME},
        CASE WHEN p_size <= 20 THEN p_brand ELSE p_type END AS description,
        CASE WHEN p_size <= 5 THEN 'meta/image' WHEN p_size > 40 THEN 'raw/image'
             ELSE 'cache/' || p_partkey END AS image_url {_LISTED_PART}""",
    "rejected_records": """SELECT p_type AS collection_id, CAST(floor(p_partkey / 1000) AS BIGINT) AS page_no,
        'token_id' AS reject_reason, 'token-' || p_partkey AS raw_token_id
        FROM part WHERE p_brand = 'Brand#7'""",
    "attach_collections": f"""WITH {_REGISTRY} SELECT CAST(id AS VARCHAR) AS collection_id, collection_name,
        contract_address, count(*) AS n_pages FROM registry JOIN lineitem ON l_suppkey + 1 = id GROUP BY ALL""",
    "enrich_metadata": f"""SELECT *, collection_id AS collection_name, collection_id AS contract_address,
        CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS image_url
        FROM ({_PART_DOCUMENT_TRAITS})""",
    "explode_outer_attributes": """WITH pairs AS (SELECT *,
            '{"trait_type":"size","value":' || p_size || '}' AS pair FROM part),
        attributes AS (SELECT *, CASE WHEN p_brand <> 'Brand#13' THEN '[' || pair || ',' || pair || ']'
            ELSE '[]' END AS attributes_json FROM pairs),
        repeated AS (SELECT * FROM attributes UNION ALL SELECT * FROM attributes WHERE p_brand <> 'Brand#13')
        SELECT CAST(p_partkey AS VARCHAR) AS token_id, attributes_json,
            '{"attributes":' || attributes_json || '}' AS metadata_json,
            CASE WHEN p_brand <> 'Brand#13' THEN 'size' END AS trait_type,
            CASE WHEN p_brand <> 'Brand#13' THEN CAST(p_size AS VARCHAR) END AS trait_value FROM repeated""",
    "wide_numbers": """WITH wide AS (SELECT *, (p_partkey + 1) || repeat('7', 60) AS w FROM part),
        pairs AS (SELECT *, 'plain' AS trait_type, w AS trait_value FROM wide
            UNION ALL SELECT *, 'minus', '-' || w FROM wide UNION ALL SELECT *, 'text', w FROM wide
            UNION ALL SELECT *, w, CASE WHEN p_size <> 0 THEN CAST(p_size AS VARCHAR) END FROM wide)
        SELECT CAST(p_partkey AS VARCHAR) AS token_id, w AS name, CAST(NULL AS VARCHAR) AS image_url,
            trait_type, trait_value FROM pairs""",
    "quarantine_bad_records": f"""SELECT p_type AS collection_id, CAST(p_partkey AS VARCHAR) AS token_id,
        CASE p_brand WHEN 'Brand#7' THEN 'attribute_not_an_object' WHEN 'Brand#8' THEN 'http_status'
             WHEN 'Brand#9' THEN 'unparsable' WHEN 'Brand#10' THEN 'raw_not_an_object'
             WHEN 'Brand#11' THEN 'metadata_not_an_object' WHEN 'Brand#12' THEN 'attributes_not_an_array'
        END AS reject_reason FROM part WHERE p_brand IN {_BAD_BRANDS}""",
    "paged_source": f"""SELECT p_type AS collection_id, CAST(p_partkey AS VARCHAR) AS token_id,
        {_LISTED_NAME} {_LISTED_PART}""",
    "land_pages": f"""SELECT p_type AS collection_id, CAST(p_partkey AS VARCHAR) AS token_id,
        {_LISTED_NAME} {_LISTED_PART}""",
    "register_collections": f"""WITH {_REGISTRY} SELECT {_NEW_IDS}, {_LABEL} AS collection_name,
        s_name AS contract_address, 'NOT_FETCHED' AS status FROM supplier WHERE s_nationkey >= 12""",
    "get_or_create_ids": f"""WITH {_REGISTRY} SELECT *, false AS created FROM registry
        UNION ALL SELECT {_NEW_IDS}, 'name of ' || s_name, NULL, 'NOT_FETCHED', true
        FROM supplier WHERE s_nationkey >= 12""",
    "registry_lookup": f"""WITH {_REGISTRY} SELECT 'name of ' || s_name AS collection_name, id,
        contract_address, status FROM supplier LEFT JOIN registry ON contract_address = s_name""",
    "registry_listing": f"WITH {_REGISTRY} SELECT collection_name, contract_address, status FROM registry",
    "status_update": f"""WITH {_REGISTRY} SELECT id, collection_name, contract_address,
        CASE WHEN s_nationkey = 8 THEN NULL WHEN s_nationkey > 5 THEN 'FETCHED' ELSE status END AS status
        FROM registry JOIN supplier ON contract_address = s_name""",
    "pending_work": f"""WITH {_REGISTRY} SELECT
        CASE WHEN status IN ('FETCHED', 'METADATA_FETCHING') THEN 'metadata' ELSE 'base' END AS stage,
        id, collection_name FROM registry WHERE status IS DISTINCT FROM 'METADATA_FETCHED'""",
    "pending_tokens": f"{_LINE_BASE} EXCEPT {_LINE_RARITY}",
    "upsert_rarity": _UPSERTED,
    "upsert_bucketed": _UPSERTED,
    "insert_missing_rows": f"""WITH old AS ({_OLD_RANKS}), new AS ({_NEW_RANKS})
        SELECT * FROM old UNION ALL SELECT * FROM new WHERE token_id NOT IN (SELECT token_id FROM old)""",
    "schema_evolving_append": """SELECT p_partkey, p_name, CAST(NULL AS INTEGER) AS p_size,
            p_type AS collection_id FROM part
        UNION ALL SELECT p_partkey, NULL, p_size, p_type FROM part""",
    "end_to_end_run": f"""WITH contracts AS (SELECT p_type AS contract_address,
            CAST(row_number() OVER (ORDER BY min(p_partkey)) AS VARCHAR) AS id FROM part GROUP BY p_type),
        {rarity_sql(
            f"SELECT collection_id, token_id, trait_type, trait_value FROM ({_PART_DOCUMENT_TRAITS})",
            f"SELECT p_type AS collection_id, CAST(p_partkey AS VARCHAR) AS token_id {_LISTED_PART}",
        ).strip()}
        SELECT id AS collection_id, token_id, rarity_score, "rank", contract_address,
               CASE WHEN collection_id IN (SELECT p_type FROM part WHERE p_brand = 'Brand#8')
               THEN 'METADATA_FETCHING' ELSE 'METADATA_FETCHED' END AS status
        FROM ranked JOIN contracts ON collection_id = contract_address""",
    "incremental_upsert": _UPSERTED,
    "incremental_ingest": f"""WITH contracts AS (SELECT p_type, CAST(row_number() OVER (ORDER BY min(p_partkey))
            AS VARCHAR) AS collection_id FROM part GROUP BY p_type)
        SELECT collection_id, count(*) AS n_base, count(*) AS n_rarity, CAST(0 AS BIGINT) AS n_missing,
            CAST(0 AS BIGINT) AS n_extra, count(CASE WHEN p_brand IN {_BAD_BRANDS} THEN 1 END)
            AS n_without_metadata
        FROM part JOIN contracts USING (p_type) WHERE p_brand <> 'Brand#7' GROUP BY ALL""",
}


_LINE_NAMES = """SELECT CAST(l_suppkey AS VARCHAR) AS collection_id,
    l_orderkey || '-' || l_linenumber AS token_id, CAST(l_linenumber % 3 AS INTEGER) AS n
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_name = 'Supplier#000000001'"""
_ORACLE["contract_report_base"] = _LINE_NAMES
_ORACLE["contract_report_metadata"] = f"{_LINE_NAMES} AND l_linenumber % 3 > 0"
_ORACLE["find_by_address"] = f"""SELECT CAST(s_suppkey AS INTEGER) AS id, {_LABEL} AS collection_name,
    s_name AS contract_address FROM supplier WHERE lower(s_name) = 'supplier#000000001'"""
_FLAGS = """SELECT CAST(l_linenumber AS VARCHAR) AS collection_id, CAST(l_partkey AS VARCHAR) AS token_id, 'flag' AS trait_type,
    l_returnflag AS trait_value FROM lineitem WHERE l_linenumber <> 1"""
_ORACLE["rank_with_overflow"] = f"""WITH {rarity_sql(_FLAGS, _FLAGS).strip()}
    SELECT * FROM ranked UNION ALL SELECT '1', NULL, NULL, NULL"""

# What failed at first is taken up, so the result is that of a run without failures.
_ORACLE["resume_after_failures"] = _ORACLE["end_to_end_run"]
_ORACLE["late_arrivals_stream"] = _ORACLE["end_to_end_run"]
_ORACLE["waiting_in_state"] = _ORACLE["end_to_end_run"]
_ORACLE["paged_pushdown"] = f"{_ORACLE['paged_source']} AND p_type = 'ECONOMY'"
_KEPT_PARTS = "(SELECT * FROM part WHERE p_partkey % 3 <> 1) part"
_ORACLE["rank_after_delta"] = _ORACLE["rarity_part"].replace("FROM part", f"FROM {_KEPT_PARTS}")
_ORACLE["rank_lookup"] = f"{_PART} SELECT * FROM ranked WHERE CAST(token_id AS BIGINT) % 7 = 0"
_ORACLE["paged_stream"] = _ORACLE["paged_source"]
_ORACLE["merged_schema_read"] = """SELECT CAST(p_partkey AS BIGINT) AS p_partkey,
    CASE WHEN p_partkey % 3 = 0 THEN p_name END AS p_name,
    CASE p_partkey % 3 WHEN 1 THEN CAST(p_size AS VARCHAR) WHEN 2 THEN 'no. ' || p_size END AS p_size,
    CASE WHEN p_partkey % 3 < 2 THEN p_type END AS p_type, CASE WHEN p_partkey % 3 = 2 THEN p_brand END AS p_brand FROM part"""
_ORACLE["sql_contract_report"] = _ORACLE["contract_report"]
_ORACLE["sql_pending"] = f"""WITH {_REGISTRY} SELECT DISTINCT id, l_orderkey || '-' || l_linenumber AS token_id
    FROM registry JOIN lineitem ON l_suppkey = id
    WHERE status IN ('FETCHED', 'METADATA_FETCHING') AND l_linenumber % 3 = 0"""
_ORACLE["audit_bitmaps"] = _ORACLE["audit_summary"]


def all_oracles() -> dict[str, str]:
    return dict(_ORACLE)
