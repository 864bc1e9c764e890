"""The five raw tables, as one subscriber frame and one frame of all events.

Plans read ``events`` (all products, one scan or one union) rather than one
product after another, so every mart makes a single pass over the facts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subpulse.rules import GAME_NAMES, PRODUCTS
from subpulse.sources.readers import SourceRegistry, read_parquet


@dataclass(frozen=True)
class Tables:
    subscribers: DataFrame
    events: DataFrame                # every event, with its product
    columns: dict[str, list[str]]    # the columns of each product's raw table

    @classmethod
    def of(cls, subscribers: DataFrame, by_product: dict[str, DataFrame]) -> Tables:
        """From separate tables: ``events`` is their union by column name.

        A filter on the product folds to a constant in each branch, so reading
        one product back scans only its own table.
        """
        tagged = [df.withColumn("product", F.lit(name)) for name, df in by_product.items()]
        events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
        return cls(subscribers, events, {name: df.columns for name, df in by_product.items()})

    def product(self, name: str) -> DataFrame:
        return self.events.filter(F.col("product") == name).select(*self.columns[name])

    def dataset(self, name: str) -> DataFrame:
        """A raw table by its dataset name, ``subscribers`` or ``events_<product>``."""
        return self.subscribers if name == "subscribers" else self.product(name.removeprefix("events_"))

    def create_views(self, prefix: str = "raw_") -> list[str]:
        names = ["subscribers"] + [f"events_{p}" for p in self.columns]
        for name in names:
            self.dataset(name).createOrReplaceTempView(prefix + name)
        return [prefix + name for name in names]


def from_registry(spark: SparkSession, registry: SourceRegistry, variant: str = "clean") -> Tables:
    return Tables.of(
        registry.read(spark, "subscribers", variant),
        {p: registry.read(spark, f"events_{p}", variant) for p in PRODUCTS},
    )


# --- adapter from the generic customer / events tables ----------------------

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _cases(key: str, values: list[str], otherwise: str) -> str:
    """CASE over small integers 0, 1, 2, ... of ``key``."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} {arms} ELSE '{otherwise}' END"


def driver_subscribers(customer: DataFrame) -> DataFrame:
    """Subscribers out of ``customer``; every hundredth one is written twice."""
    copies = F.when(F.expr("c_custkey % 100 = 0"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    start = "DATE '2023-01-01' + CAST(c_custkey * 37 % 380 AS INT)"
    return customer.select("c_custkey", "c_nationkey", "c_mktsegment", F.explode(copies).alias("dup")).selectExpr(
        "CAST(c_custkey AS STRING) AS subscriber_id",
        f"{_cases('c_custkey % 3', ['gmail.com', 'icloud.com'], 'edu')} AS email_domain",
        """CASE WHEN c_custkey % 307 = 11 THEN NULL
                WHEN c_custkey % 211 = 5 THEN 'audio_only'
                WHEN c_custkey % 223 = 7 THEN 'wirecutter_only'
                WHEN c_custkey % 7 < 2 THEN 'bundle_all'
                WHEN c_custkey % 7 = 2 THEN 'bundle_3'
                WHEN c_custkey % 7 = 3 THEN 'news_only'
                WHEN c_custkey % 7 = 4 THEN 'games_only'
                WHEN c_custkey % 7 = 5 THEN 'cooking_only'
                ELSE 'athletic_only' END AS plan_type""",
        f"CAST({start} AS STRING) AS subscription_start_date",
        f"CASE WHEN c_custkey % 9 = 0 THEN CAST({start} + 7 AS STRING) END AS subscription_end_date",
        "c_custkey % 9 = 0 AS is_churned",
        "lower(c_mktsegment) AS acquisition_channel",
        f"{_cases('c_nationkey % 5', ['US', 'GB', 'CA', 'AU'], 'IN')} AS country",
        f"{_cases('c_custkey % 2', ['mobile'], 'desktop')} AS device_primary",
        """CASE WHEN c_custkey % 401 = 13 THEN 'not-a-date'
                WHEN dup = 0 THEN '2023-12-01T00:00:00' ELSE '2024-01-15T06:30:00' END AS created_at""",
    )


# Fixed values of the mapping, repeated by the oracles:
SECTIONS = ["politics", "technology", "arts", "sports", "science", "opinion", "world"]
REFERRERS = ["direct", "search", "social", "newsletter", "push_notif"]
RECIPE_CATEGORIES = ["baking", "desserts", "drinks"]
SPORTS = ["nfl", "nba", "soccer"]
PLATFORMS = ["web", "ios", "android"]
# event type of each product for view, click, signup, purchase and anything else
_EVENT_TYPE_OF = {
    "news": ("article_view", "article_complete", "save", "share", "comment"),
    "games": ("game_start", "game_complete", "game_share", "game_complete", "streak_milestone"),
    "cooking": ("view", "cook_mode_start", "save", "cook_mode_complete", "rating_submit"),
    "athletic": ("article_view", "article_view", "liveblog_view", "podcast_play", "video_play"),
}

_COMMON = ["event_id", "subscriber_id", "event_type"]
_TAIL = ["event_timestamp", "platform", "arrival_ts"]
_OWN_COLUMNS = {
    "news": ["article_id", "section", "time_on_page_sec", "referrer"],
    "games": ["game_name", "score", "streak_days", "duration_sec"],
    "cooking": ["recipe_id", "recipe_category", "rating"],
    "athletic": ["sport", "article_id", "time_on_page_sec"],
}
DRIVER_COLUMNS = {p: [*_COMMON, *_OWN_COLUMNS[p], *_TAIL] for p in PRODUCTS}


def _pick(values: list[str] | tuple[str, ...], index: str) -> str:
    """The value at a 0-based position of a constant list."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"get(array({items}), CAST({index} AS INT))"


def _product_no(user_digit: int, event_digit: int) -> int:
    """Product of a (user_id % 10, event_id % 4) cell."""
    news, games, _, athletic = range(4)
    if user_digit == 3:
        return news
    if user_digit in (4, 6):
        other = games if user_digit == 4 else athletic
        return news if event_digit % 2 == 0 else other
    return event_digit


_CELLS = [_product_no(user, event) for user in range(10) for event in range(4)]
_CELL = "(user_id % 10 * 4 + event_id % 4)"


def _for_products(wanted: str, value: str, name: str) -> str:
    """``value`` for events of the wanted products, NULL for the others."""
    return f"IF(no IN ({', '.join(str(PRODUCTS.index(p)) for p in wanted.split())}), {value}, NULL) AS {name}"


def driver_events(events: DataFrame) -> DataFrame:
    """Every product's events out of ``events``, in one pass and row by row.

    From 8 January on a fifth of the users have no events of their own: theirs
    count for the next user, so some subscribers are idle and none of the rows is
    lost. Times stay bare columns, so that bounds on them reach the scan.

    Products and event types are looked up in constant lists, so a filter on
    them costs one lookup per row once it has been pushed below this projection.
    """
    products = _pick([PRODUCTS[no] for no in _CELLS], _CELL)
    types = _pick([t for no in _CELLS for t in _EVENT_TYPE_OF[PRODUCTS[no]]], f"{_CELL} * 5 + kind")
    return events.selectExpr(
        "*",
        "IF(user_id % 5 = 0 AND ts >= TIMESTAMP_NTZ '2024-01-08 00:00:00', user_id + 1, user_id) AS owner",
        f"get(array({', '.join(map(str, _CELLS))}), CAST({_CELL} AS INT)) AS no",
        "CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2 "
        "WHEN 'purchase' THEN 3 ELSE 4 END AS kind",
    ).selectExpr(
        f"{products} AS product",
        "event_id",
        """CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'ghost'
                ELSE CAST(owner AS STRING) END AS subscriber_id""",
        f"{types} AS event_type",
        _for_products("news athletic",
                      "concat(IF(no = 0, 'art_', 'ath_'), CAST(event_id % IF(no = 0, 9000, 7000) AS STRING))",
                      "article_id"),
        _for_products("news", _pick(SECTIONS,
                                    "event_id % 7"), "section"),
        _for_products("news athletic", "IF(event_id % 10 <> 0, value * 10, NULL)", "time_on_page_sec"),
        _for_products("news", _pick(REFERRERS, "event_id % 5"),
                      "referrer"),
        _for_products("games", _pick(GAME_NAMES, "event_id % 5"), "game_name"),
        _for_products("games", "event_id % 101", "score"),
        _for_products("games", "event_id % 121", "streak_days"),
        _for_products("games", "value", "duration_sec"),
        _for_products("cooking", "concat('rec_', CAST(event_id % 3000 AS STRING))", "recipe_id"),
        _for_products("cooking", _pick(RECIPE_CATEGORIES, "event_id % 3"), "recipe_category"),
        _for_products("cooking", "IF(event_id % 10 < 3, CAST(event_id % 5 + 1 AS DOUBLE), NULL)", "rating"),
        _for_products("athletic", _pick(SPORTS, "event_id % 3"), "sport"),
        "ts AS event_timestamp",
        f"{_pick(PLATFORMS, 'event_id % 3')} AS platform",
        """ts + (CASE WHEN IF(no = 2, day(ts) % 10 <> 1, day(ts) % 3 = 0) OR event_id % 3 = 0
                      THEN (event_id * 7919) % 12
                      WHEN event_id % 3 = 1 THEN (event_id * 7919) % 270
                      ELSE (event_id * 7919) % 900 END) * INTERVAL '1' MINUTE AS arrival_ts""",
    )


def from_driver_tables(spark: SparkSession, sf_dir: str, own_types: bool = False) -> Tables:
    """The five raw tables, derived from ``customer`` and ``events`` below ``sf_dir``.

    Declared schemas save a look into the files; ``own_types`` takes theirs, as a
    check for drift must.
    """
    customer = read_parquet(spark, f"{sf_dir}/customer.parquet", None if own_types else CUSTOMER_SCHEMA)
    events = read_parquet(spark, f"{sf_dir}/events.parquet", None if own_types else EVENTS_SCHEMA)
    return Tables(driver_subscribers(customer), driver_events(events), DRIVER_COLUMNS)


def per_product(arms: dict[str, Column]) -> Column:
    """One expression that follows the row's product."""
    items = list(arms.items())
    out = F.when(F.col("product") == items[0][0], items[0][1])
    for name, value in items[1:]:
        out = out.when(F.col("product") == name, value)
    return out
