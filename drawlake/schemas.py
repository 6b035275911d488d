"""Declared schemas and number-pool specifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Pool:
    """A set of positional number columns drawn from the domain ``lo..hi``."""

    name: str
    columns: tuple[str, ...]
    lo: int
    hi: int

    @property
    def size(self) -> int:
        return self.hi - self.lo + 1


# Fixed values of the draw-history data model: 5 main numbers in 1..50 and
# 2 star numbers in 1..12, stored in these column names.
MAIN = Pool("main", ("ball_1", "ball_2", "ball_3", "ball_4", "ball_5"), 1, 50)
STAR = Pool("star", ("lucky_star_1", "lucky_star_2"), 1, 12)
DEFAULT_POOLS: tuple[Pool, ...] = (MAIN, STAR)

NUMBER_COLUMNS = MAIN.columns + STAR.columns
CORE_COLUMNS = ("draw_date", "draw_number") + NUMBER_COLUMNS
ORDER_COLUMNS = ("draw_date", "draw_number")

# Warehouse draw table: draw_number key, unique non-null date, 7 non-null
# numbers, optional jackpot text and winner count.
DRAW_TABLE_SCHEMA = T.StructType(
    [T.StructField("draw_number", T.IntegerType(), False),
     T.StructField("draw_date", T.DateType(), False)]
    + [T.StructField(c, T.IntegerType(), False) for c in NUMBER_COLUMNS]
    + [T.StructField("jackpot", T.StringType(), True,
                     metadata={"comment": "jackpot text as published", "max_length": 30}),
       T.StructField("winners", T.IntegerType(), True)]
)

# Core analysis shape (what every analysis operator consumes).
CORE_SCHEMA = T.StructType(
    [T.StructField("draw_date", T.DateType(), True),
     T.StructField("draw_number", T.LongType(), True)]
    + [T.StructField(c, T.IntegerType(), True) for c in NUMBER_COLUMNS]
)

# Source 1 CSV, first layout (10 columns) and second layout (extra column).
SOURCE1_V1_SCHEMA = T.StructType(
    [T.StructField("DrawDate", T.StringType())]
    + [T.StructField(f"Ball {i}", T.IntegerType()) for i in range(1, 6)]
    + [T.StructField(f"Lucky Star {i}", T.IntegerType()) for i in range(1, 3)]
    + [T.StructField("UK Millionaire Maker", T.StringType()),
       T.StructField("DrawNumber", T.LongType())]
)
SOURCE1_V2_SCHEMA = T.StructType(
    SOURCE1_V1_SCHEMA.fields[:9]
    + [T.StructField("European Millionaire Maker", T.StringType()),
       T.StructField("DrawNumber", T.LongType())]
)
SOURCE1_RENAMES = {
    "DrawDate": "draw_date", "Ball 1": "ball_1", "Ball 2": "ball_2", "Ball 3": "ball_3",
    "Ball 4": "ball_4", "Ball 5": "ball_5", "Lucky Star 1": "lucky_star_1",
    "Lucky Star 2": "lucky_star_2", "UK Millionaire Maker": "uk_millionaire_maker",
    "DrawNumber": "draw_number",
}

# Source 2 CSV (';' separated).
SOURCE2_SCHEMA = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [T.StructField(f"N{i}", T.IntegerType()) for i in range(1, 6)]
    + [T.StructField(f"E{i}", T.IntegerType()) for i in range(1, 3)]
    + [T.StructField("Winner", T.StringType()), T.StructField("Gain", T.StringType())]
)
SOURCE2_RENAMES = {
    "Date": "draw_date", "N1": "ball_1", "N2": "ball_2", "N3": "ball_3", "N4": "ball_4",
    "N5": "ball_5", "E1": "lucky_star_1", "E2": "lucky_star_2",
}

# Scraped CSV: everything but the date kept as text.
SCRAPED_COLUMNS = ("draw_date",) + NUMBER_COLUMNS + ("jackpot", "winners")

# JSON-lines export with upper-case keys.
EXPORT_JSON_SCHEMA = T.StructType(
    [T.StructField("DRAW_DATE", T.StringType()), T.StructField("DRAW_NUMBER", T.LongType())]
    + [T.StructField(c.upper(), T.LongType()) for c in NUMBER_COLUMNS]
    + [T.StructField("JACKPOT", T.StringType()), T.StructField("WINNERS", T.LongType())]
)
