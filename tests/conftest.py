import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfproof.schema import TABLE_SCHEMAS, Tables  # noqa: E402
from shelfproof.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, memory="8g")


AS_OF = date(2026, 7, 1)

# One valid article, header, item and listing; tests override single fields.
ARTICLE = {"article_id": "A1", "article_description": "Sparkling Water 1", "article_type": "single",
           "merch_category": "DRINKS_COLD", "sub_category": "Water", "base_uom": "EA",
           "barcode": "9300000000019", "tax_code": "GST", "list_price": 5.0, "cost_price": 3.0,
           "status": "active", "created_date": date(2024, 1, 1),
           "last_modified_date": date(2024, 1, 1)}
HEADER = {"promo_id": "P1", "promo_theme": "T", "header_start": date(2026, 6, 25),
          "header_end": date(2026, 7, 8), "store_group": "G1", "approval_status": "live",
          "created_by": "x", "created_date": date(2026, 6, 1)}
ITEM = {"promo_item_id": "I1", "promo_id": "P1", "article_id": "A1", "mechanic": "fixed_price",
        "promo_price": 4.0, "item_start": date(2026, 6, 25), "item_end": date(2026, 7, 8)}
LISTED = {"store_group": "G1", "article_id": "A1", "valid_from": date(2024, 1, 1),
          "valid_to": date(2099, 12, 31)}


@pytest.fixture(scope="session")
def make(spark):
    """Tables from partial rows; each row starts from the valid one."""
    def rows(table, base, overrides):
        names = TABLE_SCHEMAS[table].names
        return spark.createDataFrame(
            [tuple({**base, **o}.get(n) for n in names) for o in overrides],
            TABLE_SCHEMAS[table])

    def build(articles=({},), headers=({},), items=({},), listing=({},)):
        return Tables({"article_master": rows("article_master", ARTICLE, articles),
                       "promotion_header": rows("promotion_header", HEADER, headers),
                       "promotion_item": rows("promotion_item", ITEM, items),
                       "listing": rows("listing", LISTED, listing)})
    return build
