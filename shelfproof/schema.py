"""Data model: table types, keys, controlled vocabularies and rule metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


S, D, DT, I, L, B = (T.StringType(), T.DoubleType(), T.DateType(), T.IntegerType(),
                     T.LongType(), T.BooleanType())

# Column names and order of the six tables and of the outputs.
TABLE_SCHEMAS: dict[str, T.StructType] = {
    "article_master": _struct(
        article_id=S, article_description=S, article_type=S, parent_article_id=S,
        merch_category=S, sub_category=S, base_uom=S, barcode=S, tax_code=S,
        list_price=D, cost_price=D, tobacco_floor_price=D, status=S,
        discontinued_date=DT, created_date=DT, last_modified_date=DT),
    "article_site": _struct(
        article_id=S, store_group=S, site_list_price=D, listed=B, stock_status=S,
        last_modified_date=DT),
    "listing": _struct(store_group=S, article_id=S, valid_from=DT, valid_to=DT),
    "promotion_header": _struct(
        promo_id=S, promo_theme=S, header_start=DT, header_end=DT, store_group=S,
        approval_status=S, created_by=S, created_date=DT),
    "promotion_item": _struct(
        promo_item_id=S, promo_id=S, article_id=S, mechanic=S, promo_price=D,
        discount_value=D, multibuy_qty=I, item_start=DT, item_end=DT),
    "change_log": _struct(
        change_id=S, table_name=S, record_id=S, change_type=S, field_changed=S,
        old_value=S, new_value=S, changed_by=S, changed_at=DT),
}

EXCEPTION_SCHEMA = _struct(
    table_name=S, record_id=S, error_type=S, severity=S, downstream_impact=S,
    description=S, store_group=S)
TRUTH_SCHEMA = _struct(
    gt_id=S, table_name=S, record_id=S, error_type=S, severity=S,
    downstream_impact=S, field_changed=S, old_value=S, new_value=S)
SCORECARD_SCHEMA = _struct(
    error_type=S, ground_truth=L, found=L, TP=L, FP=L, FN=L, precision=D, recall=D)

RULE_COLUMNS = EXCEPTION_SCHEMA.names[:6]

PRIMARY_KEYS: dict[str, list[str]] = {
    "article_master": ["article_id"],
    "article_site": ["article_id", "store_group"],
    "listing": ["store_group", "article_id"],
    "promotion_header": ["promo_id"],
    "promotion_item": ["promo_item_id"],
    "change_log": ["change_id"],
}

# Controlled vocabularies.
ARTICLE_TYPES = ["single", "generic", "variant", "display", "prepack"]
BASE_UOMS = ["EA", "L", "PACK", "CTN"]
ARTICLE_STATUS = ["active", "discontinued", "pending"]
PROMO_MECHANICS = ["fixed_price", "percent_off", "dollar_off", "multibuy"]
PROMO_STATUS = ["draft", "approved", "live", "expired", "cancelled"]
SEVERITY_ORDER = ["Critical", "High", "Medium", "Low"]

# Category, base unit, tax code, is tobacco, may be promoted.
CATEGORIES = [
    ("FUEL", "L", "GST", False, True),
    ("TOBACCO", "EA", "GST", True, False),
    ("DRINKS_COLD", "EA", "GST", False, True),
    ("FOOD_TO_GO", "EA", "GST_FREE", False, True),
    ("CONFECTIONERY", "EA", "GST", False, True),
]

# Rule, severity, label, downstream impact.
RULE_FACTS = [
    ("referential_integrity", "Critical", "Missing article reference",
     "Promo fails to load; price file rejects record"),
    ("referential_timing", "High", "Discontinued before promo",
     "Promo advertised on an article stores can no longer order"),
    ("listing_conflict", "High", "Not ranged in store group",
     "Advertised deal a customer physically can't buy in that store"),
    ("header_item_date_mismatch", "Medium", "Item outside campaign dates",
     "Item prices live when the campaign isn't, or vice versa"),
    ("orphaned_cancelled_header", "Critical", "Cancelled promo still live",
     "Old promo price still charged at POS"),
    ("uom_pack_mismatch", "Medium", "Multibuy on non-unit article",
     "Mechanic can't be applied; POS error"),
    ("tobacco_on_promotion", "Critical", "Tobacco on promotion",
     "Regulatory / compliance breach: tobacco promotion is not legal in Australia"),
    ("margin_breach", "High", "Priced below cost",
     "Unintended loss-making sale"),
    ("barcode_invalidity", "Critical", "Invalid barcode",
     "Won't scan at POS; scan-and-go / self-checkout failure"),
    ("duplicate_near_duplicate", "Low", "Duplicate article",
     "Split sales reporting; double replenishment"),
    ("completeness", "Low", "Missing required field",
     "Downstream tax/finance and ordering errors"),
    ("stale_status", "Low", "Expired but marked live",
     "Expired promo still treated as active"),
]
RULE_NAMES = [name for name, *_ in RULE_FACTS]
SEVERITY = {name: severity for name, severity, _, _ in RULE_FACTS}
LABEL = {name: label for name, _, label, _ in RULE_FACTS}
IMPACT = {name: impact for name, _, _, impact in RULE_FACTS}

# The truth log keeps the older name and wording of the tobacco defect.
TRUTH_ALIAS = {"tobacco_on_promotion": "tobacco_floor_breach"}
TRUTH_SEVERITY = {TRUTH_ALIAS.get(k, k): v for k, v in SEVERITY.items()}
TRUTH_IMPACT = {TRUTH_ALIAS.get(k, k): v for k, v in IMPACT.items()}
TRUTH_IMPACT["tobacco_floor_breach"] = "Regulatory / compliance breach"

# Error types whose truth is logged on another record than the exception.
TRUTH_UNIT = {
    "referential_timing": "article_id",
    "uom_pack_mismatch": "article_id",
    "orphaned_cancelled_header": "promo_id",
}

REFERENCE_DATE = date(2026, 7, 1)


class Tables(Mapping[str, DataFrame]):
    """The six tables by name. Values are lazy DataFrames, or functions building one."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        unknown = sorted(set(frames) - set(TABLE_SCHEMAS))
        if unknown:
            raise KeyError(f"unknown tables: {', '.join(unknown)}")
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def replace(self, **frames: DataFrame | Callable[[], DataFrame]) -> Tables:
        return Tables({**self._frames, **frames})


class SchemaMismatch(ValueError):
    pass


def check_columns(df: DataFrame, table: str, types: bool = False) -> None:
    """Raise if the column names (or, on request, the types) differ from the declared table."""
    declared = {f.name: f.dataType for f in TABLE_SCHEMAS[table].fields}
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    if missing := [c for c in declared if c not in actual]:
        problems.append(f"missing {missing}")
    if unexpected := [c for c in actual if c not in declared]:
        problems.append(f"unexpected {unexpected}")
    if types:
        problems += [f"{c} is {actual[c].simpleString()}, declared {declared[c].simpleString()}"
                     for c in declared if c in actual and actual[c] != declared[c]]
    if problems:
        raise SchemaMismatch(f"{table}: " + "; ".join(problems))


def rule_dimension(spark: SparkSession) -> DataFrame:
    """Twelve rows: error_type, severity, severity_rank, check, downstream_impact."""
    rows = [(name, sev, SEVERITY_ORDER.index(sev), label, impact)
            for name, sev, label, impact in RULE_FACTS]
    return spark.createDataFrame(
        rows, "error_type string, severity string, severity_rank int, check string, "
              "downstream_impact string")


def severity_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(enumerate(SEVERITY_ORDER)), "severity_rank int, severity string")


def category_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CATEGORIES, "merch_category string, category_uom string, category_tax string, "
                    "is_tobacco boolean, promotable boolean")
