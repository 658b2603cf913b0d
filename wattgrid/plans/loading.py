"""Q-load: raw wide price files to the ``prices_day_ahead`` table shape."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedupe as D
from ..operators import reshape as R
from ..operators import timeaxis as tx
from ..schemas import CONCEPT_TO_COUNTRY

TS, KEY, PRICE = "timestamp", "country", "price_eur_mwh"


def wide_price_rows(wide: DataFrame, mode: str = "label", carry: tuple[str, ...] = ()) -> DataFrame:
    """Wide price rows -> ``(timestamp, country, price_eur_mwh, source, *carry)``, nothing dropped but missing values.

    S1 P1 R1 R2 P4 P6 in one lazy plan: filter both concepts in one pass, unpivot the hour
    columns, drop missing values, stamp the hour, map the concept to a country code.
    """
    w = wide.filter(F.col("CONCEPT").isin(list(CONCEPT_TO_COUNTRY)))
    long = R.wide_to_long(w, ["DATE", "CONCEPT", "source", *carry], value_col=PRICE,
                          include_h25=(mode == "market"))
    long = tx.hour_labels_to_timestamp(long, "DATE", "hour_index", mode)
    cmap = F.create_map(*[x for k, v in CONCEPT_TO_COUNTRY.items() for x in (F.lit(k), F.lit(v))])
    return long.select(TS, cmap[F.col("CONCEPT")].alias(KEY), PRICE, "source", *carry)


def load_wide_prices(wide: DataFrame, mode: str = "label", keep: str = "first") -> DataFrame:
    """Q-load: ``wide_price_rows`` with the first row per key by source name."""
    return D.keep_first(wide_price_rows(wide, mode), [TS, KEY], ["source", PRICE], keep)
