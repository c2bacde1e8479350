"""Board readers as table functions of SQL.

    SELECT * FROM read_board(TABLE(SELECT source_id, url, body FROM bodies) PARTITION BY (source_id), 'tables')

The second argument decides what is read and so which columns come back: `tables` gives the cells of every table of every page, as
`layouts.table_rows` starts from, `offsets` the hidden offset of a source's pages, as `layouts.offsets` does.
"""

from __future__ import annotations

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from tallyboard.sources.layouts import DEFINITION, STATED, offset_of, slice_tables

_CELL = StructType().add("html", "string").add("header", BooleanType()).add("colspan", IntegerType())
SCHEMAS = {
    "tables": StructType().add("source_id", "string").add("source", "string").add("place", IntegerType()).add("row", IntegerType()).add("cells", ArrayType(_CELL)),
    "offsets": StructType().add("source_id", "string").add("offset", DoubleType()).add("code", "string"),
}
NEEDS = ("source_id", "url", "body")


@udtf
class ReadBoard:
    @staticmethod
    def analyze(bodies: AnalyzeArgument, what: AnalyzeArgument) -> AnalyzeResult:
        if not bodies.isTable:
            raise ValueError("read_board reads a TABLE argument")
        if not what.isConstantExpression or what.value not in SCHEMAS:
            raise ValueError(f"read_board reads one of {', '.join(SCHEMAS)}")
        missing = [c for c in NEEDS if c not in bodies.dataType.names]
        if missing:
            raise ValueError(f"read_board needs the columns {', '.join(missing)}")
        return AnalyzeResult(schema=SCHEMAS[what.value])

    def __init__(self) -> None:
        self.what, self.source, self.texts, self.stated = None, None, 0, []
        self.values: set[float] = set()

    def eval(self, bodies: Row, what: str):
        self.what, self.source = what, bodies["source_id"]
        body = bodies["body"] or ""
        if what == "tables":
            for place, (_, rows) in enumerate(slice_tables(body)):
                for k, cells in enumerate(rows):
                    yield self.source, bodies["url"], place, k, cells
            return
        found = DEFINITION.findall(body)
        self.texts += len(found)
        self.values |= {v for v in map(offset_of, found) if v is not None}
        if said := STATED.search(body):
            try:
                self.stated.append(float(said[1]))
            except ValueError:
                pass

    def terminate(self):
        """What all pages of a source together say."""
        if self.what != "offsets":
            return
        values = sorted(self.values)
        if not self.texts:
            code = "no_definition"
        elif not values:
            code = "no_offset"
        elif len(values) > 1:
            code = "offsets_disagree"
        elif any(round(values[0] + s, 4) for s in self.stated):
            code = "offset_not_as_stated"
        else:
            code = None
        yield self.source, None if code else values[0], code


def register(spark: SparkSession) -> None:
    """Makes `read_board` known to the session's SQL."""
    spark.udtf.register("read_board", ReadBoard)
