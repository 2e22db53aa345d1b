"""A generator of replies as a data source: prompts by number, in ranges for a batch, by offsets for a stream.

A prompt that fails with tools is asked again without them; what still fails is a row
with its error, so no prompt is lost and none stops the others. A stream's offset is
the number of the next prompt: a restart goes on there, and a larger total asks for the
new prompts only.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

REPLY = "prompt_id long, prompt string, reply string, with_tools boolean, attempts int, error string"
_NAMES = (f"generated_replies_{i}" for i in itertools.count())

#: Takes a prompt and a list of tools (or None) and gives a reply, or raises.
Client = Callable[[str, list | None], str]


class Prompts(InputPartition):
    """The prompts from one number to before another."""

    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def asked(client: Client, prompt: str, tools: list | None, attempts: int) -> tuple[str | None, bool, int, str | None]:
    """(reply, whether tools were offered, attempts, error): the last attempt goes without tools, if there were any."""
    error, offered = None, False
    for attempt in range(1, attempts + 1):
        offered = tools is not None and (attempt < attempts or attempts == 1)
        try:
            return client(prompt, tools if offered else None), offered, attempt, None
        except Exception as e:  # noqa: BLE001  a client may raise anything
            error = f"{type(e).__name__}: {e}"
    return None, offered, attempts, error


def _source(make_client: Callable[[], Client], prompt: Callable[[int], str], total: int, each: int, tools: list | None, attempts: int) -> type[DataSource]:
    def ranges(start: int, end: int) -> list[Prompts]:
        return [Prompts(a, min(a + each, end)) for a in range(start, end, each)]

    def replies(part: Prompts) -> Iterator[tuple]:
        client = make_client()
        for i in range(part.start, part.end):
            text = prompt(i)
            yield (i, text, *asked(client, text, tools, attempts))

    class Batch(DataSourceReader):
        def partitions(self) -> list[Prompts]:
            return ranges(0, total)

        def read(self, partition: Prompts) -> Iterator[tuple]:
            return replies(partition)

    class Stream(DataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"next": 0}

        def latestOffset(self) -> dict:
            return {"next": total}

        def partitions(self, start: dict, end: dict) -> list[Prompts]:
            return ranges(start["next"], end["next"])

        def read(self, partition: Prompts) -> Iterator[tuple]:
            return replies(partition)

        def commit(self, end: dict) -> None:
            pass

    own = next(_NAMES)

    class Replies(DataSource):
        @classmethod
        def name(cls) -> str:
            return own

        def schema(self) -> str:
            return REPLY

        def reader(self, schema) -> DataSourceReader:
            return Batch()

        def streamReader(self, schema) -> DataSourceStreamReader:
            return Stream()

    return Replies


def replies(spark: SparkSession, make_client: Callable[[], Client], prompt: Callable[[int], str], total: int, stream: bool = False, each: int = 64, tools: list | None = None, attempts: int = 2) -> DataFrame:
    """REPLY rows of prompts 0 to before total. make_client is called once a task; a task asks `each` prompts."""
    source = _source(make_client, prompt, total, each, tools, attempts)
    spark.dataSource.register(source)
    return (spark.readStream if stream else spark.read).format(source.name()).load()
