"""Sources that hand out a listing page by page, read on the executors.

How a page is fetched is injected: ``fetch(contract, page_key)`` returns the response
status and body, with ``page_key`` None for the first page. The pages of one contract
form a chain and are read by one task, but streamed row by row and never held together.
A long chain that broke off can go on from a page further down. Metadata documents have no
order, so those of one contract are spread over all tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, replace

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
)
from pyspark.sql.types import StructType

from traitrank.schemas import DOCUMENTS, PAGES

# What runs on the executors travels with the job; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Fetch = Callable[[str, str | None], tuple[int, str]]
PageRow = tuple[str, int, int, str]


# Status of the row that ends a chain whose next key was had before.
LOOP = 508
_ROWS = 64


def page_chain(fetch: Fetch, contract: str, page_key: str | None = None, page_no: int = 0) -> Iterator[PageRow]:
    """All pages of a contract from the given one on, as rows of ``PAGES``.

    The chain ends with a failed response, an empty page or a page without a next key. A next
    key that was had before gives one more row, failed with status ``LOOP``. A fetch that raises
    fails the task, which Spark runs again.
    """
    had = {page_key}
    while True:
        status, body = fetch(contract, page_key)
        yield contract, page_no, status, body
        page_key = _next_key(body) if status == 200 else None
        if not page_key:
            return
        page_no += 1
        if page_key in had:
            yield contract, page_no, LOOP, ""
            return
        had.add(page_key)


def _next_key(body: str) -> str | None:
    """Key of the page after this one; None after an empty or a last page."""
    page = json.loads(body)
    return (page.get("pageKey") or None) if page.get("nfts") else None


def _columns(schema: StructType) -> str:
    return schema.simpleString()[len("struct<") : -1].replace(":", " ")


def _tasks(df: DataFrame) -> int:
    """Four per core: the work lies in waiting for responses, which the size of a list does not show."""
    return 4 * df.sparkSession.sparkContext.defaultParallelism


def land_pages(contracts: DataFrame, fetch: Fetch, tasks: int | None = None) -> DataFrame:
    """Pages of all ``contracts`` (contract_address[, page_key, page_no]), one chain per contract.

    With ``page_key`` and its ``page_no`` a chain starts there, at the earliest one if a contract
    has several; NULLs stand for the first page. The contracts are spread over ``tasks`` tasks.
    """

    def read(batches):
        import pandas as pd

        for batch in batches:
            for contract, page_key, page_no in zip(*(batch[c] for c in ("contract_address", "page_key", "page_no"))):
                first = (page_key, int(page_no)) if isinstance(page_key, str) else (None, 0)
                for row in page_chain(fetch, contract, *first):
                    yield pd.DataFrame([row], columns=PAGES.names)

    start = [F.col(c) if c in contracts.columns else F.lit(None) for c in ("page_no", "page_key")]
    start = F.struct(start[0].cast("long").alias("page_no"), start[1].cast("string").alias("page_key"))
    once = contracts.groupBy("contract_address").agg(F.min(start).alias("start"))
    spread = once.select("contract_address", "start.page_key", F.coalesce("start.page_no", F.lit(0)).alias("page_no"))
    return spread.repartition(tasks or _tasks(contracts), "contract_address").mapInPandas(read, _columns(PAGES))


def land_documents(tokens: DataFrame, fetch: Fetch, landed_no: int, tasks: int | None = None) -> DataFrame:
    """Documents of all ``tokens`` (contract_address, token_id) as rows of ``DOCUMENTS``.

    ``fetch(contract, token_id)`` returns status and body; what failed is a row as well. All rows
    bear the ``landed_no`` of this landing. Tokens are spread over ``tasks`` tasks whatever their
    contract.
    """

    def read(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for contract, token in zip(batch["contract_address"], batch["token_id"]):
                answer = dict(zip(("http_status", "body"), fetch(contract, token)))
                rows.append({"contract_address": contract, "token_id": token, "landed_no": landed_no, **answer})
                if len(rows) == _ROWS:
                    yield pd.DataFrame(rows)[DOCUMENTS.names]
                    rows = []
            if rows:
                yield pd.DataFrame(rows)[DOCUMENTS.names]

    keys = ["contract_address", "token_id"]
    spread = tokens.select(*keys).distinct().repartition(tasks or _tasks(tokens), *keys)
    return spread.mapInPandas(read, _columns(DOCUMENTS))


class _ContractPartition(InputPartition):
    def __init__(self, contract: str):
        super().__init__(contract)


# The setting that lets filters reach a source written in Python.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _addresses(condition: Filter) -> set[str] | None:
    """The contracts that a filter is for, None if it is about something else."""
    if getattr(condition, "attribute", None) != ("contract_address",):
        return None
    if isinstance(condition, EqualTo):
        return {condition.value}
    return set(condition.value) if isinstance(condition, In) else None


def paged_source(fetch: Fetch, source_name: str = "paged_listing", pushdown: bool = False) -> type[DataSource]:
    """Data source class for ``spark.dataSource.register``; reads the option ``contracts``.

    The option is a JSON array of addresses; every address is an input partition. With
    ``pushdown`` a filter that names addresses leaves the others unread; the session then needs
    ``PUSHDOWN``, without which Spark refuses such a source.
    """

    class Reader(DataSourceReader):
        def __init__(self, contracts: list[str]):
            self.contracts = contracts

        def partitions(self) -> list[InputPartition]:
            return [_ContractPartition(c) for c in self.contracts]

        def read(self, partition: InputPartition) -> Iterator[PageRow]:
            # Without a contract Spark asks for a partition that is none.
            return iter(()) if partition is None else page_chain(fetch, partition.value)

    class PushedReader(Reader):
        def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
            for condition in filters:
                named = _addresses(condition)
                if named is None:
                    yield condition
                else:
                    self.contracts = [c for c in self.contracts if c in named]

    class PagedListing(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name

        def schema(self) -> StructType:
            return PAGES

        def reader(self, schema: StructType) -> DataSourceReader:
            return (PushedReader if pushdown else Reader)(list(dict.fromkeys(json.loads(self.options["contracts"]))))

    return PagedListing


@dataclass(frozen=True)
class Mark:
    """Where a chain stands after a round: the page to fetch next, and whether there is one.

    ``anchor`` is a key that was had ``steps`` pages ago. It moves on after 1, 2, 4 ... pages, so a
    chain that runs in a circle comes back to it, however long the circle is.
    """

    page_key: str | None = None
    page_no: int = 0
    open: bool = True
    anchor: str | None = None
    steps: int = 0
    span: int = 1

    def after(self, key: str | None) -> Mark:
        """The mark after a page that names ``key`` as the next one."""
        if not key:
            return replace(self, page_no=self.page_no + 1, open=False)
        moved = self.steps + 1 == self.span
        return Mark(
            key, self.page_no + 1, True,
            key if moved else self.anchor, 0 if moved else self.steps + 1, 2 * self.span if moved else self.span,
        )


class Marks:
    """Marks of all chains after each round, a small file each, in a folder that all executors share."""

    def __init__(self, folder: str):
        self.folder = folder

    def _file(self, round_no: int, contract: str) -> str:
        return f"{round_no}/{hashlib.sha256(contract.encode()).hexdigest()}.json"

    def read(self, round_no: int, contract: str) -> Mark:
        if not round_no:
            return Mark()
        system, base = file_system(self.folder)
        with system.open_input_stream(f"{base}/{self._file(round_no, contract)}") as stream:
            return Mark(**json.loads(stream.read()))

    def write(self, round_no: int, contract: str, mark: Mark) -> None:
        """Under a name of its own first, so that no reader finds half a mark."""
        system, base = file_system(self.folder)
        target = f"{base}/{self._file(round_no, contract)}"
        system.create_dir(target.rsplit("/", 1)[0], recursive=True)
        draft = f"{target}.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as stream:
            stream.write(json.dumps(asdict(mark)).encode())
        system.move(draft, target)

    def last_round(self, contracts: list[str]) -> int:
        """The last round after which all chains have a mark."""
        from pyarrow import fs

        system, base = file_system(self.folder)
        rounds = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
        for round_no in sorted((int(f.base_name) for f in rounds), reverse=True):
            marked = system.get_file_info(fs.FileSelector(f"{base}/{round_no}"))
            if sum(f.base_name.endswith(".json") for f in marked) == len(contracts):
                return round_no
        return 0

    def any_open(self, contracts: list[str]) -> bool:
        last = self.last_round(contracts)
        return any(self.read(last, c).open for c in contracts)


class _RoundPartition(InputPartition):
    def __init__(self, contract: str, start: int, end: int):
        super().__init__((contract, start, end))


def _comes_again(status: int) -> bool:
    """Whether a page that failed so is asked for again: too many requests, or a fault of the server."""
    return status == 429 or status >= 500


def paged_stream(fetch: Fetch, source_name: str = "paged_stream") -> type[DataSource]:
    """Streaming data source class for ``spark.dataSource.register``.

    Options: ``contracts``, a JSON array of addresses, fixed for the stream; ``marks``, a shared
    folder; ``pages``, the most pages of a chain in one round. A batch is a round: every chain goes
    on from the page key in its mark of the round before, read by its own task, and leaves a mark
    for the next. With ``growing`` set to ``true`` a batch is as many rounds as lie behind it, one at
    least, so a chain takes batches by the logarithm of its length and one that breaks off costs at
    most what was had before; rows are streamed, whatever the number of pages. The offset is the number of the round, so neither pages nor keys reach the
    driver. A round that breaks off is played again from the marks before it. A page that failed
    for the moment is a row and is fetched again in the next round; other failures end the chain.
    A chain that comes back to an earlier page ends with a row of status ``LOOP``, at the latest after twice
    the circle. Rounds end when no chain is open.
    """

    class StreamReader(DataSourceStreamReader):
        def __init__(self, options: dict):
            self.contracts = list(dict.fromkeys(json.loads(options["contracts"])))
            self.marks = Marks(options["marks"])
            self.pages = int(options.get("pages", 100))
            self.growing = options.get("growing", "false").lower() == "true"

        def initialOffset(self) -> dict:
            return {"round": 0}

        def latestOffset(self) -> dict:
            last = self.marks.last_round(self.contracts)
            if last and not self.marks.any_open(self.contracts):
                return {"round": last}
            return {"round": last + (max(1, last) if self.growing else 1)}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            return [_RoundPartition(c, start["round"], end["round"]) for c in self.contracts]

        def read(self, partition: InputPartition) -> Iterator[PageRow]:
            contract, start, end = partition.value
            mark = self.marks.read(start, contract)
            for _ in range(self.pages * (end - start)):
                if not mark.open:
                    break
                status, body = fetch(contract, mark.page_key)
                yield contract, mark.page_no, status, body
                if status != 200:
                    mark = replace(mark, open=_comes_again(status))
                    break
                key = _next_key(body)
                anchor, mark = mark.anchor, mark.after(key)
                if key and key == anchor:
                    yield contract, mark.page_no, LOOP, ""
                    mark = replace(mark, open=False)
            self.marks.write(end, contract, mark)

    class PagedStream(DataSource):
        @classmethod
        def name(cls) -> str:
            return source_name

        def schema(self) -> StructType:
            return PAGES

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return StreamReader(self.options)

    return PagedStream


def pyarrow_uri(uri: str) -> str:
    """A folder's name as pyarrow knows it, from the one that Spark uses."""
    return re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/(?!/)", "file:///", uri))


def file_system(uri: str):
    """File system and path of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(pyarrow_uri(uri) if ":" in uri else f"file://{uri}")


# Characters that Spark writes as % and two hex digits in folder names.
_ESCAPED = {ord(c): f"%{ord(c):02X}" for c in "\"#%'*/:=?\\\x7f{[]^" + "".join(map(chr, range(1, 32)))}


def folder_fetch(root: str) -> Fetch:
    """Fetches pages kept as text files under ``root/contract_address=…/page_no=…/``.

    ``root`` may lie on any file system that pyarrow reaches. The page key is the number
    of the page in its folder name. Several part files of a page are its body in order of names.
    """

    def fetch(contract: str, page_key: str | None) -> tuple[int, str]:
        from pyarrow import fs

        system, base = file_system(root)
        folder = f"{base}/contract_address={contract.translate(_ESCAPED)}/page_no={page_key or 0}"
        listed = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        parts = sorted(f.path for f in listed if f.base_name.startswith("part-"))
        if not parts:
            return 404, ""
        texts = []
        for part in parts:
            with system.open_input_stream(part) as stream:
                texts.append(stream.read().decode("utf-8").rstrip("\n"))
        return 200, "\n".join(texts)

    return fetch
