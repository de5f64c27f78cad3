"""Lookups and reports as SQL functions that give tables, for users who write SQL.

The functions live as long as the session. Their arguments are values like any others, so they can be
bound: ``spark.sql("SELECT * FROM contract_rarity(:address)", args={"address": "0x…"})``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from traitrank.operators.registry import AWAITING
from traitrank.schemas import BASE, METADATA, NOT_FETCHED, RARITY, REGISTRY, TableNames


@dataclass(frozen=True)
class Relations:
    """Tables or views that the functions read."""

    registry: str
    base: str
    metadata: str
    rarity: str

    @classmethod
    def of(cls, names: TableNames) -> Relations:
        return cls(*[names.full(kind) for kind in ("registry", "base", "metadata", "rarity")])


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _selected(schema) -> str:
    return ", ".join(f"t.`{f.name}`" for f in schema)


def install(spark: SparkSession, tables: Relations, prefix: str = "") -> None:
    """Creates, or creates anew, in this session and with ``prefix`` before each name:

    * ``contract_base``, ``contract_metadata`` and ``contract_rarity`` ``(address)``: the rows of a contract
      in any spelling; tables partitioned by collection are pruned at run time;
    * ``pending_collections(stage)``: collections that wait for ``base`` or ``metadata``;
    * ``pending_tokens(collection)``: listed tokens of a collection without metadata, NULL for all.
    """

    def create(name: str, arguments: str, columns: str, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}"
        )

    for kind, schema in (("base", BASE), ("metadata", METADATA), ("rarity", RARITY)):
        create(
            f"contract_{kind}", "address STRING", _columns(schema),
            f"""SELECT {_selected(schema)} FROM {getattr(tables, kind)} t
                JOIN {tables.registry} r ON t.collection_id = CAST(r.id AS STRING)
                WHERE lower(r.contract_address) = lower(address)""",
        )
    states = " OR ".join(
        f"(stage = '{stage}' AND coalesce(t.status, '{NOT_FETCHED}') IN ({', '.join(map(repr, of))}))"
        for stage, of in AWAITING.items()
    )
    create(
        "pending_collections", "stage STRING", _columns(REGISTRY),
        f"SELECT {_selected(REGISTRY)} FROM {tables.registry} t WHERE {states}",
    )
    create(
        "pending_tokens", "collection STRING", "collection_id STRING, token_id STRING",
        f"""SELECT DISTINCT t.collection_id, t.token_id FROM {tables.base} t
            LEFT ANTI JOIN {tables.metadata} m ON t.collection_id = m.collection_id AND t.token_id = m.token_id
            WHERE t.token_id IS NOT NULL AND (collection IS NULL OR t.collection_id = collection)""",
    )
