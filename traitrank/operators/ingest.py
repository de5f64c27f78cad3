"""Landed JSON to typed rows: listing pages to base tokens, metadata documents to traits.

Nothing fails silently: what cannot be used carries a ``reject_reason`` and can be written
to a quarantine table, while the rest of the batch goes through. Each record of a page is a
VARIANT of its own, so neither the size of a body nor a key that an object repeats costs more
than one record; of repeated keys the last one counts.

Which landing of a page or document is opened is chosen by number, without the bodies. A ledger
(collection_id, stage, item, landed_no, ok) keeps what became of it: a failed response is opened
again only after a newer landing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank import schemas
from traitrank.functions import (
    exact_text_or_null,
    first_truthy,
    has_wide_number,
    is_truthy,
    parse_token_id,
    stringify_or_null,
    variant_at,
)
from traitrank.operators.joins import lookup_join

_ADDRESS_KEY = "__address"
_COLLECTION = ["collection_id", "collection_name", "contract_address"]


def _fields(value: Column, *names: str) -> Column:
    """Struct of the named members as variants; NULL unless ``value`` is an object."""
    return F.try_variant_get(value, "$", f"struct<{','.join(f'{n}:variant' for n in names)}>")


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


# No cap on a string's length, and the text of what is no object of the wanted form.
_BAD = "__bad"
_READ_ALL = {"maxStringLen": str(2**31 - 1), "columnNameOfCorruptRecord": _BAD}
# A VARIANT holds no more than 128 MiB.
_LARGE = 100 << 20


def _repeated_keys(df: DataFrame) -> None:
    """Objects may repeat a key, as for most JSON readers; set where bodies are parsed."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _good_body() -> Column:
    """The body; NULL for a failed response, whose body is not looked at."""
    return F.when(F.col("http_status") == 200, F.col("body"))


def _unparsable() -> Column:
    return F.when(F.octet_length("body") >= _LARGE, "too_large").otherwise("unparsable")


def _bad_response() -> Column:
    return F.col("http_status").isNull() | (F.col("http_status") != 200)


def attach_collection(landed: DataFrame, registry: DataFrame, spread: str = "page_no") -> DataFrame:
    """Landed rows of registered contracts with id, name and registered spelling of the address.

    A contract may hold any share of the rows: the registry is broadcast if its size allows,
    else the address is salted with ``spread``.
    """
    known = registry.filter(F.col("contract_address").isNotNull()).select(
        F.lower("contract_address").alias(_ADDRESS_KEY),
        F.col("id").cast("string").alias("collection_id"),
        "collection_name",
        "contract_address",
    )
    keyed = landed.withColumn(_ADDRESS_KEY, F.lower("contract_address")).drop("contract_address")
    return lookup_join(keyed, known, [_ADDRESS_KEY], spread=[spread]).drop(_ADDRESS_KEY)


def _open_pages(pages: DataFrame) -> DataFrame:
    """Adds the page's records as variants and the reason to reject the page.

    The page as a whole is parsed only if it has no array of records, to tell why.
    """
    _repeated_keys(pages)
    page = _fields(F.col("page"), "nfts")
    tokens = page["nfts"]
    return (
        pages.withColumn("opened", F.from_json(_good_body(), f"nfts array<variant>, {_BAD} string", _READ_ALL))
        .withColumn("tokens", F.col("opened.nfts"))
        .withColumn("page", F.when(F.col("tokens").isNull(), F.try_parse_json(_good_body())))
        .withColumn(
            "page_reject",
            F.when(_bad_response(), "http_status")
            .when(F.col("tokens").isNotNull(), F.when(F.col(f"opened.{_BAD}").isNotNull(), "unparsable"))
            .when(F.col("page").isNull(), _unparsable())
            .when(page.isNull(), "not_an_object")
            .when(is_truthy(tokens), "tokens_not_an_array"),
        )
    )


def page_records(pages: DataFrame) -> DataFrame:
    """What became of every page and record, from one pass over the bodies.

    Expects the columns of ``attach_collection``. A record of a good page is a row with its
    token and texts, or with a ``reject_reason`` and its JSON as ``body``. A rejected page
    is one row with its reason and body, an empty page one row with neither. A fallback
    text that is missing or not an object's member counts as absent.
    """
    # A rejected page must yield its single row whatever it holds.
    usable = F.when(F.col("page_reject").isNull(), F.col("tokens"))
    record = F.col("record")

    def at(path: str) -> Column:
        return variant_at(record, path)

    reason = F.coalesce(
        F.col("page_reject"),
        F.when(F.col("record_no").isNotNull() & _fields(record, "tokenId").isNull(), "record_not_an_object"),
        F.when(F.col("record_no").isNotNull() & F.col("token_id").isNull(), "token_id"),
    )
    rejected = F.col("reject_reason").isNotNull()
    landing = [c for c in ("landed_no",) if c in pages.columns]
    return (
        _open_pages(pages)
        .select(
            *_COLLECTION,
            "page_no",
            *landing,
            "page_reject",
            F.when(F.col("page_reject").isNotNull(), F.col("body")).alias("page_body"),
            F.posexplode_outer(usable).alias("record_no", "record"),
        )
        .select(
            *_COLLECTION,
            parse_token_id(stringify_or_null(at("$.tokenId"))).alias("token_id"),
            first_truthy(at("$.metadata.name"), at("$.raw.metadata.name"), at("$.title")).alias("name"),
            first_truthy(
                at("$.metadata.description"), at("$.raw.metadata.description"), at("$.description")
            ).alias("description"),
            first_truthy(
                at("$.metadata.image"), at("$.raw.metadata.image"), at("$.image.cachedUrl")
            ).alias("image_url"),
            "page_no",
            *landing,
            "record_no",
            "page_reject",
            "page_body",
            "record",
        )
        .withColumn("reject_reason", reason)
        .withColumn("body", F.coalesce("page_body", F.when(rejected, F.to_json("record"))))
        .drop("page_reject", "page_body", "record")
    )


def listed_tokens(records: DataFrame) -> DataFrame:
    """The base rows among ``page_records``, with their place in the listing."""
    return records.filter(F.col("token_id").isNotNull()).select(
        *schemas.BASE.names, "page_no", "record_no"
    )


def rejected_records(records: DataFrame) -> DataFrame:
    """The rejected pages and records among ``page_records``."""
    return records.filter(F.col("reject_reason").isNotNull()).select(
        *_COLLECTION, "page_no", "record_no", "reject_reason", "body"
    )


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One base row per listed token with a usable id, plus its place in the listing."""
    return listed_tokens(page_records(pages))


def first_listing(listed: DataFrame) -> DataFrame:
    """One base row per token: its first place in the listing. Copies meet before the shuffle."""
    rest = [c for c in schemas.BASE.names if c not in schemas.TOKEN_KEYS]
    return (
        listed.groupBy(*schemas.TOKEN_KEYS)
        .agg(F.min(F.struct("page_no", "record_no", *rest)).alias("first"))
        .select(*schemas.TOKEN_KEYS, *[F.col(f"first.{c}").alias(c) for c in rest])
        .select(*schemas.BASE.names)
    )


def enrichable_tokens(base: DataFrame) -> DataFrame:
    """Distinct base tokens that a metadata document can be asked for."""
    return (
        base.filter(
            F.col("token_id").isNotNull()
            & (F.col("token_id") != "")
            & F.col("contract_address").isNotNull()
        )
        .select(*_COLLECTION, "token_id")
        .distinct()
    )


def with_landing(landed: DataFrame) -> DataFrame:
    """``landed`` with ``landed_no``, NULL where the source does not number its landings."""
    return landed if "landed_no" in landed.columns else landed.withColumn("landed_no", F.lit(None).cast("long"))


def _answered() -> Column:
    return F.coalesce(F.col("http_status") == 200, F.lit(False))


def best_landing(landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, landed_no, answered): a good response before a failed one, then the last landed.

    Bodies take no part, so only numbers are shuffled.
    """
    return (
        landed.groupBy(*keys)
        .agg(F.max(F.struct(_answered().alias("answered"), "landed_no")).alias("best"))
        .select(*keys, "best.landed_no", "best.answered")
    )


def not_in_ledger(best: DataFrame, ledger: DataFrame, stage: str, item: Column) -> DataFrame:
    """Landings that the ledger lacks, or has as failed with an older number."""
    known = ledger.filter(F.col("stage") == stage).select(
        "collection_id", F.col("item").alias("__item"), F.col("landed_no").alias("__no"), F.col("ok").alias("__ok")
    )
    joined = best.withColumn("__item", item).join(known, ["collection_id", "__item"], "left")
    newer = F.coalesce(F.col("landed_no") > F.col("__no"), F.lit(True))
    return joined.filter(F.col("__ok").isNull() | (~F.col("__ok") & newer)).select(*best.columns)


def bodies_of(landed: DataFrame, best: DataFrame, keys: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """The rows of ``landed`` that ``best`` chose; bodies are shuffled only if it is too large to send."""
    chosen = best.select(*keys, F.col("landed_no").alias("__no"), F.col("answered").alias("__answered"))
    met = lookup_join(landed, chosen, keys, spread=spread)
    same = F.col("landed_no").eqNullSafe(F.col("__no")) & (_answered() == F.col("__answered"))
    return met.filter(same).drop("__no", "__answered")


def wanted_pages(attached: DataFrame, ledger: DataFrame) -> DataFrame:
    """Of landed pages of registered contracts those to open: the best landing of each page that
    the ledger does not have yet."""
    keys = ["collection_id", "page_no"]
    best = not_in_ledger(best_landing(attached, keys), ledger, "base", F.col("page_no").cast("string"))
    return bodies_of(attached, best, keys, [])


def wanted_documents(tokens: DataFrame, documents: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Tokens (collection columns, token_id) with the document to open, one per token.

    Documents of other contracts are dropped before anything is shuffled; tokens without a
    document, or with one that the ledger has, are left out.
    """
    keyed = tokens.withColumn(_ADDRESS_KEY, F.lower("contract_address"))
    contracts = keyed.select(_ADDRESS_KEY).distinct()
    theirs = with_landing(documents).withColumn(_ADDRESS_KEY, F.lower("contract_address")).drop("contract_address")
    theirs = lookup_join(theirs, contracts, [_ADDRESS_KEY], how="left_semi", spread=["token_id"])
    keys = [_ADDRESS_KEY, "token_id"]
    best = keyed.join(best_landing(theirs, keys), keys).select(*keyed.columns, "landed_no", "answered")
    if ledger is not None:
        best = not_in_ledger(best, ledger, "metadata", F.col("token_id"))
    bodies = bodies_of(theirs, best.select(*keys, "landed_no", "answered").distinct(), keys, [])
    found = best.drop("landed_no", "answered").join(bodies, keys)
    # Equal numbers leave several bodies; the greatest text is taken, so that reruns agree.
    return (
        found.groupBy(*_COLLECTION, "token_id", "landed_no", "http_status").agg(F.max("body").alias("body"))
        if "landed_no" not in documents.columns
        else found.select(*_COLLECTION, "token_id", "landed_no", "http_status", "body")
    )


def join_documents(base: DataFrame, documents: DataFrame) -> DataFrame:
    """Base tokens with their document. Tokens without a document are left out."""
    return wanted_documents(enrichable_tokens(base), documents).drop("landed_no")


# The texts of a document as they stand in its JSON, whatever their type.
_EXACT = "raw struct<metadata struct<name string, description string, image string, attributes array<struct<trait_type string, value string>>>>"


def _open_documents(joined: DataFrame) -> DataFrame:
    """Adds the metadata members, the attributes and the reason to reject the document.

    Absent ``raw``, ``metadata`` or ``attributes`` count as empty; an explicit null or
    another type in place of an object does not, and one attribute that is not an object
    rejects the whole token.
    """
    _repeated_keys(joined)
    raw = _fields(F.col("raw"), "metadata")
    return (
        joined.withColumn("opened", F.from_json(_good_body(), f"raw variant, {_BAD} string", _READ_ALL))
        .withColumn("raw", F.col("opened.raw"))
        # Only a document that is no object is parsed as a whole, to tell why.
        .withColumn("doc", F.when(F.col(f"opened.{_BAD}").isNotNull(), F.try_parse_json(_good_body())))
        .withColumn("metadata", raw["metadata"])
        # Opened a second time only where a whole number has more digits than a VARIANT keeps.
        .withColumn("exact", F.when(has_wide_number(_good_body()), F.from_json(_good_body(), _EXACT, _READ_ALL)["raw"]["metadata"]))
        .withColumn("m", _fields(F.col("metadata"), "name", "description", "image", "attributes"))
        .withColumn("attributes", F.col("m.attributes"))
        .withColumn("items", _items(F.col("attributes")))
        .withColumn("pairs", F.transform("items", lambda item: _fields(item, "trait_type", "value")))
        .withColumn(
            "reject_reason",
            F.when(_bad_response(), "http_status")
            .when(
                F.col("opened").isNull() | F.col(f"opened.{_BAD}").isNotNull(),
                F.when(F.col("doc").isNull(), _unparsable()).otherwise("not_an_object"),
            )
            .when(F.col("raw").isNotNull() & raw.isNull(), "raw_not_an_object")
            .when(F.col("metadata").isNotNull() & F.col("m").isNull(), "metadata_not_an_object")
            .when(
                F.col("items").isNull() & is_truthy(F.col("attributes")), "attributes_not_an_array"
            )
            .when(F.exists("pairs", lambda pair: pair.isNull()), "attribute_not_an_object"),
        )
    )


def document_records(joined: DataFrame) -> DataFrame:
    """What became of every document, from one pass over the bodies.

    A usable document is a row with its texts and trait pairs, another one a row with its
    ``reject_reason`` and ``body``. Further columns of ``joined`` stay.
    """
    none = F.array(F.lit(None).cast("struct<trait_type:variant,value:variant>"))

    def texts_of(pair: Column, i: Column) -> Column:
        exact = F.get(F.col("exact.attributes"), i)
        return F.struct(
            exact_text_or_null(pair["trait_type"], exact["trait_type"]).alias("trait_type"),
            exact_text_or_null(pair["value"], exact["value"]).alias("trait_value"),
        )

    texts = F.transform(F.when(F.size("pairs") > 0, F.col("pairs")).otherwise(none), texts_of)
    kept = [c for c in joined.columns if c not in (*_COLLECTION, "token_id", "body")]
    return _open_documents(joined).select(
        *_COLLECTION,
        "token_id",
        *kept,
        exact_text_or_null(F.col("m.name"), F.col("exact.name")).alias("name"),
        exact_text_or_null(F.col("m.description"), F.col("exact.description")).alias("description"),
        exact_text_or_null(F.col("m.image"), F.col("exact.image")).alias("image_url"),
        F.coalesce(F.to_json("attributes"), F.lit("[]")).alias("attributes_json"),
        F.coalesce(F.to_json("metadata"), F.lit("{}")).alias("metadata_json"),
        F.when(F.col("reject_reason").isNull(), texts).alias("traits"),
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), F.col("body")).alias("body"),
    )


def trait_rows(records: DataFrame) -> DataFrame:
    """One row per (token, attribute) among ``document_records``; a token without attributes
    keeps one row without trait."""
    # An inner explode would be guarded by a filter on the array's size, which Spark pushes below all
    # joins, with the whole parse of the body inside; a rejected document has no array at all.
    pairs = records.select(*schemas.METADATA.names[:-2], F.explode_outer("traits").alias("pair"))
    return pairs.filter(F.col("pair").isNotNull()).select(
        *schemas.METADATA.names[:-2], "pair.trait_type", "pair.trait_value"
    )


def bad_documents(records: DataFrame) -> DataFrame:
    """Documents that give no trait row, with the reason, among ``document_records``."""
    return records.filter(F.col("reject_reason").isNotNull()).select(
        *_COLLECTION, "token_id", "reject_reason", "body"
    )


def flatten_metadata(joined: DataFrame) -> DataFrame:
    """``trait_rows`` of tokens with their document."""
    return trait_rows(document_records(joined))


def rejected_documents(joined: DataFrame) -> DataFrame:
    """``bad_documents`` of tokens with their document."""
    records = document_records(joined)
    # Through a generator no filter is pushed, so the reason is worked out once.
    once = records.select(F.explode_outer(F.array(F.struct(*records.columns))).alias("record"))
    return bad_documents(once.select("record.*"))
