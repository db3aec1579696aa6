"""The registered queries once more, as plain SQL on the driver tables.

Written apart from the DataFrame code. Each text is a chain of named subqueries: the adapter (with
defects, or clean), where needed the injection, and the query itself.
"""

from __future__ import annotations

# Fixed values, written out here once more so that a wrong fact in the package does not pass:
# rule, severity, label, downstream impact.
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
SEVERITY = {name: severity for name, severity, _, _ in RULE_FACTS}
LABEL = {name: label for name, _, label, _ in RULE_FACTS}
IMPACT = {name: impact for name, _, _, impact in RULE_FACTS}
# The truth log's name and impact of the tobacco rule.
TRUTH_SEVERITY = {"tobacco_floor_breach": "Critical"} | {
    name: severity for name, severity in SEVERITY.items() if name != "tobacco_on_promotion"}
TRUTH_IMPACT = {"tobacco_floor_breach": "Regulatory / compliance breach"} | {
    name: impact for name, impact in IMPACT.items() if name != "tobacco_on_promotion"}

TODAY = "DATE '1998-07-01'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _hex(h: str, start: int) -> str:
    return f"('0x' || substr({h}, {start}, 7))::BIGINT"


def _pad(prefix: str, number: str, width: int) -> str:
    return f"printf('{prefix}%0{width}d', {number})"


# ---- adapter ----------------------------------------------------------------------------

_STATUS = "CASE WHEN {k} % 13 = 3 THEN 'discontinued' WHEN {k} % 17 = 4 THEN 'pending' ELSE 'active' END"
_UOM = ("CASE WHEN {null} WHEN p_type = 'STANDARD' THEN 'L' WHEN {k} % 10 = 3 THEN 'PACK' "
        "WHEN {k} % 10 = 4 THEN 'CTN' ELSE 'EA' END")


def _adapter(clean: bool) -> str:
    no = "FALSE THEN NULL"
    uom = _UOM.format(k="p_partkey", null=no if clean else "p_partkey % 41 = 5 THEN NULL")
    tax_null = no if clean else "p_partkey % 43 = 6 THEN NULL"
    spoil = "FALSE" if clean else "p_partkey % 20 = 7"
    code = " || ' ' || substr(md5(p_partkey::VARCHAR), 1, 16)" if clean else ""
    status_extra = "" if clean else (
        "WHEN o % 23 = 1 THEN NULL WHEN o % 29 = 2 THEN 'cancelled' WHEN o % 31 = 3 THEN 'live' ")
    parent = "'ART' || lpad((p_partkey - p_partkey % 10)::VARCHAR, 8, '0')"
    known = " AND p_partkey - p_partkey % 10 IN (SELECT p_partkey FROM part)" if clean else ""
    if clean:
        mechanic = (f"CASE n % 4 WHEN 0 THEN 'fixed_price' WHEN 1 THEN 'percent_off' "
                    f"WHEN 2 THEN 'dollar_off' ELSE CASE WHEN "
                    f"({_UOM.format(k='k', null=no)}) <> 'EA' THEN 'fixed_price' ELSE 'multibuy' END END")
        article, factor, end = _pad("ART", "k", 8), "0.9::DOUBLE", "header_end"
        keep = f"WHERE ({_STATUS.format(k='k')}) = 'active' AND p_type <> 'ECONOMY'"
        listed = "k % 13 <> 3"
    else:
        mechanic = ("CASE n % 4 WHEN 0 THEN 'fixed_price' WHEN 1 THEN 'percent_off' "
                    "WHEN 2 THEN 'dollar_off' ELSE 'multibuy' END")
        article = f"CASE WHEN s % 50 = 0 THEN 'ARTFAKE' || k ELSE {_pad('ART', 'k', 8)} END"
        factor = "CASE WHEN s % 19 = 0 THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END"
        end = "header_end + CASE WHEN (o * 7 + n) % 17 = 0 THEN 2 + n ELSE 0 END"
        keep = ""
        listed = "s % 50 <> 0 AND ((k + o) % 20 <> 0 OR k % 3 <> 0)"
    return f"""
article_master AS MATERIALIZED (
  SELECT *, body || (CASE WHEN {spoil} THEN (c + 1) % 10 ELSE c END)::VARCHAR AS barcode
  FROM (
    SELECT *, (10 - list_sum(list_transform(range(1, 13), lambda i:
        substr(body, i::INT, 1)::INT * (CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END))) % 10) % 10 AS c
    FROM (
      SELECT p_partkey, {_pad('ART', 'p_partkey', 8)} AS article_id,
        p_name || ' ' || p_type || ' ' || p_size{code} AS article_description,
        CASE WHEN p_partkey % 10 = 0 THEN 'generic' WHEN p_partkey % 10 IN (1, 2) THEN 'variant'
             WHEN p_partkey % 10 = 3 THEN 'prepack' WHEN p_partkey % 10 = 4 THEN 'display'
             ELSE 'single' END AS article_type,
        CASE WHEN p_partkey % 10 IN (1, 2){known} THEN {parent} END AS parent_article_id,
        CASE p_type WHEN 'ECONOMY' THEN 'TOBACCO' WHEN 'STANDARD' THEN 'FUEL'
             WHEN 'SMALL' THEN 'CONFECTIONERY' WHEN 'LARGE' THEN 'FOOD_TO_GO'
             ELSE 'DRINKS_COLD' END AS merch_category,
        p_brand AS sub_category, {uom} AS base_uom,
        '93' || lpad(p_partkey::VARCHAR, 10, '0') AS body,
        CASE WHEN {tax_null} WHEN p_type = 'LARGE' THEN 'GST_FREE' ELSE 'GST' END AS tax_code,
        p_retailprice AS list_price, p_retailprice * 0.7::DOUBLE AS cost_price,
        CASE WHEN p_type = 'ECONOMY' THEN p_retailprice * 0.93::DOUBLE END AS tobacco_floor_price,
        {_STATUS.format(k='p_partkey')} AS status,
        CASE WHEN p_partkey % 13 = 3
             THEN DATE '1995-01-01' + ((p_partkey * 37) % 2400)::INT END AS discontinued_date,
        DATE '1992-01-01' + (p_partkey % 1000)::INT AS created_date,
        DATE '1992-01-01' + (p_partkey % 1000 + p_partkey % 365)::INT AS last_modified_date
      FROM part))),
promotion_header AS MATERIALIZED (
  SELECT *, {_pad('PRM', 'o', 8)} AS promo_id,
    CASE {status_extra}WHEN header_end < {TODAY} THEN 'expired'
      WHEN header_start > {TODAY} THEN CASE WHEN o % 5 < 2 THEN 'draft' ELSE 'approved' END
      ELSE 'live' END AS approval_status,
    o_orderpriority || ' ' || year(header_start) AS promo_theme,
    header_start - (o % 31)::INT AS created_date
  FROM (
    SELECT *, header_start + (7 * CASE WHEN o % 100 < 70 THEN 1 WHEN o % 100 < 90 THEN 2
                                   WHEN o % 100 < 96 THEN 3 ELSE 4 END - 1)::INT AS header_end
    FROM (
      SELECT o_orderkey AS o, o_orderpriority, c_name AS created_by,
        {_pad('SG_', 'c_nationkey', 2)} AS store_group,
        o_orderdate::DATE + ((3 - (isodow(o_orderdate::DATE) - 1) + 7) % 7)::INT AS header_start
      FROM orders JOIN customer ON o_custkey = c_custkey))),
lines AS MATERIALIZED (
  SELECT l.l_orderkey AS o, l.l_linenumber AS n, l.l_partkey AS k, l.l_suppkey AS sk, l.l_quantity::BIGINT AS qty,
    l.l_orderkey + l.l_linenumber AS s, p.p_type, p.p_retailprice,
    h.promo_id, h.header_start, h.header_end, h.store_group
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey JOIN promotion_header h ON h.o = l.l_orderkey),
promotion_item AS MATERIALIZED (
  SELECT printf('PIT%08d', o) || '_' || n || '_' || k || '_' || sk || '_' || qty AS promo_item_id, promo_id, {article} AS article_id,
    mechanic,
    CASE WHEN mechanic IN ('fixed_price', 'multibuy') THEN p_retailprice * ({factor}) END
      AS promo_price,
    CASE mechanic WHEN 'percent_off' THEN (10 + 5 * (s % 4))::DOUBLE
      WHEN 'dollar_off' THEN 0.5::DOUBLE + 0.25::DOUBLE * (s % 8) END AS discount_value,
    CASE mechanic WHEN 'multibuy' THEN (2 + s % 2)::INT END AS multibuy_qty,
    header_start AS item_start, ({end})::DATE AS item_end
  FROM (SELECT *, {mechanic} AS mechanic FROM lines) {keep}),
listing AS MATERIALIZED (
  SELECT DISTINCT store_group, {_pad('ART', 'k', 8)} AS article_id,
    DATE '1994-01-01' + (k % 300)::INT AS valid_from, DATE '2099-12-31' AS valid_to
  FROM lines WHERE {listed})"""


DIRTY, CLEAN = _adapter(False), _adapter(True)


def _with(base: str, query: str) -> str:
    kind = "WITH RECURSIVE" if "lcs AS (" in base else "WITH"
    return f"{kind} {base}\n{query}"


# ---- the rules, over tables named a, h, i, l --------------------------------------------

def _money(x: str) -> str:
    return f"({x})::DECIMAL(12,2)::VARCHAR"


def _exception(name: str, table: str, key: str, description: str, rest: str) -> str:
    return (f"SELECT '{table}' AS table_name, {key} AS record_id, '{name}' AS error_type, "
            f"{_q(SEVERITY[name])} AS severity, {_q(IMPACT[name])} AS downstream_impact, "
            f"{description} AS description FROM {rest}")


def _pairs(prefix: str) -> str:
    """Subqueries that score all article pairs of a category."""
    return f"""
{prefix}tok AS MATERIALIZED (
  SELECT article_id AS id, parent_article_id AS parent, merch_category AS cat, toks,
    array_to_string(toks, ' ') AS norm
  FROM (SELECT *, list_sort(list_distinct(list_filter(
          regexp_split_to_array(article_description, '\\s+'), lambda x: x <> ''))) AS toks
        FROM {prefix}article_master)
  WHERE merch_category IS NOT NULL AND len(toks) > 0),
{prefix}rest AS MATERIALIZED (
  SELECT *, CASE WHEN s > 0 THEN 1 ELSE 0 END AS gap, length(da) AS la, length(db) AS lb
  FROM (
    SELECT a.id AS a, b.id AS b, a.cat, a.norm AS na, b.norm AS nb,
      length(array_to_string(list_filter(a.toks, lambda x: list_contains(b.toks, x)), ' ')) AS s,
      array_to_string(list_filter(a.toks, lambda x: NOT list_contains(b.toks, x)), ' ') AS da,
      array_to_string(list_filter(b.toks, lambda x: NOT list_contains(a.toks, x)), ' ') AS db
    FROM {prefix}tok a JOIN {prefix}tok b ON a.cat = b.cat AND a.id < b.id
    WHERE (b.parent IS NULL OR b.parent <> a.id) AND (a.parent IS NULL OR a.parent <> b.id))),
{prefix}lcs AS (
  SELECT da, db, 0 AS step, list_transform(range(0, length(db)), lambda j: 0::BIGINT) AS line
  FROM (SELECT DISTINCT da, db FROM {prefix}rest
        WHERE la > 0 AND lb > 0 AND 100 * levenshtein(da, db) <= 3 * (2 * (s + gap) + la + lb))
  UNION ALL
  SELECT da, db, step + 1, list_transform(range(1, length(db) + 1), lambda j: greatest(line[j],
    coalesce(list_max(list_transform(list_filter(range(1, j + 1),
      lambda q: substr(db, q::INT, 1) = substr(da, step + 1, 1)),
      lambda q: 1 + CASE WHEN q = 1 THEN 0 ELSE line[q - 1] END)), 0)))
  FROM {prefix}lcs WHERE step < length(da)),
{prefix}indel AS MATERIALIZED (
  SELECT da, db, length(da) + length(db) - 2 * line[length(db)] AS d FROM {prefix}lcs
  WHERE step = length(da)),
{prefix}near AS MATERIALIZED (
  SELECT * FROM (
    SELECT r.*, CASE WHEN s > 0 AND (la = 0 OR lb = 0) THEN 100.0::DOUBLE ELSE greatest(
      CASE WHEN d IS NOT NULL THEN 100.0::DOUBLE - 100.0::DOUBLE * d / (2 * (s + gap) + la + lb) END,
      CASE WHEN s > 0 THEN 100.0::DOUBLE - 100.0::DOUBLE * (1 + la) / (2 * s + 1 + la) END,
      CASE WHEN s > 0 THEN 100.0::DOUBLE - 100.0::DOUBLE * (1 + lb) / (2 * s + 1 + lb) END)
      END AS score,
      CASE WHEN s > 0 AND (la = 0 OR lb = 0) THEN TRUE ELSE
        coalesce(100 * d <= 3 * (2 * (s + gap) + la + lb), FALSE)
        OR (s > 0 AND (100 * (1 + la) <= 3 * (2 * s + 1 + la)
                       OR 100 * (1 + lb) <= 3 * (2 * s + 1 + lb))) END AS hit
    FROM {prefix}rest r LEFT JOIN {prefix}indel USING (da, db)) WHERE hit),
{prefix}matched AS MATERIALIZED (
  SELECT b AS record_id, min(a) AS first_match, arg_min(score, a) AS score, count(*) AS matches
  FROM {prefix}near GROUP BY b)"""


def _rules(p: str = "") -> dict[str, str]:
    """Rule -> SQL over the tables with prefix p."""
    a, h, i, l = (f"{p}{t}" for t in ("article_master", "promotion_header", "promotion_item",
                                      "listing"))
    item = "promotion_item"
    return {
        "referential_integrity": _exception(
            "referential_integrity", item, "promo_item_id",
            "'promo_item ' || promo_item_id || ' references article_id ''' || article_id || "
            "''', which does not exist in article_master.'",
            f"{i} WHERE NOT EXISTS (SELECT 1 FROM {a} x WHERE x.article_id = {i}.article_id)"),
        "referential_timing": _exception(
            "referential_timing", item, "promo_item_id",
            "'promo_item ' || promo_item_id || ' promotes article ''' || article_id || "
            "''', discontinued on ' || discontinued_date || ', before the promo item started on ' "
            "|| item_start || '.'",
            f"{i} JOIN {a} USING (article_id) "
            "WHERE status = 'discontinued' AND discontinued_date < item_start"),
        "listing_conflict": _exception(
            "listing_conflict", item, "promo_item_id",
            "'promo_item ' || promo_item_id || ' promotes article ''' || i.article_id || "
            "''' in store_group ''' || h.store_group || ''', but the article isn''t listed there.'",
            f"{i} i JOIN {h} h USING (promo_id) LEFT JOIN {l} l ON l.article_id = i.article_id "
            f"AND l.store_group = h.store_group WHERE l.valid_from IS NULL "
            f"AND i.article_id IN (SELECT article_id FROM {a})"),
        "header_item_date_mismatch": _exception(
            "header_item_date_mismatch", item, "promo_item_id",
            "'promo_item ' || promo_item_id || ' runs ' || item_start || ' to ' || item_end || "
            "', outside header window ' || h.header_start || ' to ' || h.header_end || '.'",
            f"{i} i JOIN {h} h USING (promo_id) WHERE item_start IS NULL OR item_end IS NULL "
            "OR item_start < h.header_start OR item_start > h.header_end "
            "OR item_end < h.header_start OR item_end > h.header_end"),
        "orphaned_cancelled_header": _exception(
            "orphaned_cancelled_header", item, "promo_item_id",
            "'promo_item ' || promo_item_id || '''s header (' || promo_id || ') is cancelled, "
            "but the item still runs until ' || item_end || '.'",
            f"{i} JOIN {h} h USING (promo_id) "
            f"WHERE h.approval_status = 'cancelled' AND item_end >= {TODAY}"),
        "uom_pack_mismatch": _exception(
            "uom_pack_mismatch", item, "promo_item_id",
            "'promo_item ' || promo_item_id || ' uses multibuy on article ''' || article_id || "
            "''', sold as ' || base_uom || ', not EA.'",
            f"{i} JOIN {a} USING (article_id) WHERE mechanic = 'multibuy' AND base_uom <> 'EA'"),
        "tobacco_on_promotion": _exception(
            "tobacco_on_promotion", item, "promo_item_id",
            "'promo_item ' || promo_item_id || ' promotes tobacco article ''' || article_id || '''.'",
            f"{i} JOIN {a} USING (article_id) WHERE merch_category = 'TOBACCO'"),
        "margin_breach": _exception(
            "margin_breach", item, "promo_item_id",
            "'promo_item ' || promo_item_id || ' prices article ''' || article_id || ''' at $' || "
            f"{_money('promo_price')} || ', below cost $' || {_money('cost_price')} || '.'",
            f"{i} JOIN {a} USING (article_id) "
            "WHERE mechanic IN ('fixed_price', 'multibuy') AND promo_price < cost_price"),
        "barcode_invalidity": _exception(
            "barcode_invalidity", "article_master", "article_id",
            "'article ''' || article_id || ''' has barcode ''' || barcode || ''', invalid check digit.'",
            f"{a} WHERE NOT coalesce({_ean('barcode')}, FALSE)"),
        "duplicate_near_duplicate": _exception(
            "duplicate_near_duplicate", "article_master", "record_id",
            "'article ''' || record_id || ''' looks like a near-duplicate of ''' || first_match || "
            "''', similarity ' || round_even(score, 0)::BIGINT || '%.'", f"{p}matched"),
        "completeness": _exception(
            "completeness", "article_master", "article_id",
            "'article ''' || article_id || ''' missing: ' || concat_ws(', ', "
            "CASE WHEN base_uom IS NULL THEN 'base_uom' END, "
            "CASE WHEN tax_code IS NULL THEN 'tax_code' END) || '.'",
            f"{a} WHERE base_uom IS NULL OR tax_code IS NULL") + " UNION ALL " + _exception(
            "completeness", "promotion_header", "promo_id",
            "'promotion_header ''' || promo_id || ''' missing approval_status.'",
            f"{h} WHERE approval_status IS NULL"),
        "stale_status": _exception(
            "stale_status", "promotion_header", "promo_id",
            "'promotion_header ''' || promo_id || ''' marked live but header_end (' || header_end "
            "|| ') has passed.'",
            f"{h} WHERE approval_status = 'live' AND header_end < {TODAY}"),
    }


def _ean(code: str) -> str:
    """Thirteen digits whose weighted sum is a multiple of ten."""
    weighted = (f"list_sum(list_transform(range(1, 14), lambda i: "
                f"(ascii(substr({code}, i::INT, 1)) - 48) * (CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)))")
    return (f"(length({code}) = 13 AND regexp_full_match({code}, '[0-9]{{13}}') "
            f"AND {weighted} % 10 = 0)")


def _worklist(p: str = "") -> str:
    """Subqueries up to {p}worklist, which has the store group."""
    union = " UNION ALL ".join(_rules(p).values())
    return f"""{_pairs(p)},
{p}flat AS MATERIALIZED ({union}),
{p}worklist AS MATERIALIZED (
  SELECT f.*, CASE f.table_name WHEN 'promotion_item' THEN hi.store_group
                                WHEN 'promotion_header' THEN hh.store_group END AS store_group
  FROM {p}flat f
  LEFT JOIN {p}promotion_item i ON f.table_name = 'promotion_item' AND i.promo_item_id = f.record_id
  LEFT JOIN {p}promotion_header hi ON hi.promo_id = i.promo_id
  LEFT JOIN {p}promotion_header hh ON f.table_name = 'promotion_header' AND hh.promo_id = f.record_id),
{p}labels_ AS (SELECT * FROM (VALUES {", ".join(f"({_q(n)}, {_q(lb)})" for n, _, lb, _ in RULE_FACTS)})
  AS t(error_type, "check"))"""


# ---- injection --------------------------------------------------------------------------

def _sample(pool: str, key: str, rate: float, tag: str) -> str:
    return (f"(SELECT * FROM (SELECT *, md5('7:{tag}:' || {key}) AS hs, "
            f"row_number() OVER (ORDER BY md5('7:{tag}:' || {key})) AS rn, count(*) OVER () AS cnt "
            f"FROM {pool}) WHERE rn <= greatest(1, floor(cnt * {rate}::DOUBLE)))")


def _draw(name: str, key: str, start: int = 1) -> str:
    return _hex(f"md5('7:{name}-value:' || {key})", start)


def _unit(name: str, key: str) -> str:
    return f"({_draw(name, key)}::DOUBLE / 268435456.0::DOUBLE)"


_TOUCHED = ("(SELECT article_id FROM s02 UNION SELECT article_id FROM s06 "
            "UNION SELECT article_id FROM s09)")
_INJECT = f"""{CLEAN},
s01 AS MATERIALIZED (SELECT *, 'ARTFAKE_' || promo_item_id AS new_article
  FROM {_sample('promotion_item', 'promo_item_id', 0.06, 'referential_integrity')}),
s02 AS MATERIALIZED (SELECT t.*, a.status AS old,
    t.item_start - (5 + {_draw('referential_timing', 't.promo_item_id')} % 55)::INT AS new_date
  FROM {_sample('promotion_item', 'promo_item_id', 0.05, 'referential_timing')} t
  JOIN article_master a USING (article_id)
  WHERE t.promo_item_id NOT IN (SELECT promo_item_id FROM s01)),
pairs_gone AS MATERIALIZED (SELECT DISTINCT t.article_id, h.store_group
  FROM {_sample('promotion_item', 'promo_item_id', 0.05, 'listing_conflict')} t
  JOIN promotion_header h USING (promo_id)
  JOIN listing l ON l.article_id = t.article_id AND l.store_group = h.store_group
  WHERE t.promo_item_id NOT IN (SELECT promo_item_id FROM s01)),
s03 AS MATERIALIZED (SELECT i.promo_item_id, i.article_id, h.store_group
  FROM promotion_item i JOIN promotion_header h USING (promo_id)
  JOIN pairs_gone g ON g.article_id = i.article_id AND g.store_group = h.store_group
  WHERE i.promo_item_id NOT IN (SELECT promo_item_id FROM s01)),
s04 AS MATERIALIZED (SELECT t.*,
    h.header_end + (2 + {_draw('header_item_date_mismatch', 't.promo_item_id')} % 8)::INT AS new_end
  FROM {_sample('promotion_item', 'promo_item_id', 0.06, 'header_item_date_mismatch')} t
  JOIN promotion_header h USING (promo_id)),
s05 AS MATERIALIZED (SELECT * FROM {_sample(
    "(SELECT * FROM promotion_header WHERE approval_status IN ('live', 'approved') AND promo_id IN "
    f"(SELECT promo_id FROM promotion_item WHERE item_end >= {TODAY}))",
    'promo_id', 0.25, 'orphaned_cancelled_header')}),
s06 AS MATERIALIZED (SELECT t.*, a.base_uom AS old,
    CASE WHEN {_draw('uom_pack_mismatch', 't.article_id')} % 2 = 0 THEN 'CTN' ELSE 'PACK' END AS new_uom
  FROM {_sample('''(SELECT * FROM promotion_item WHERE mechanic = 'multibuy'
      AND (promo_item_id IN (SELECT promo_item_id FROM s01)
           OR article_id NOT IN (SELECT article_id FROM s02)))''',
      'promo_item_id', 0.30, 'uom_pack_mismatch')} t
  JOIN article_master a USING (article_id)
  WHERE t.promo_item_id NOT IN (SELECT promo_item_id FROM s01)),
s07 AS MATERIALIZED (SELECT 'PITTOB_' || article_id AS promo_item_id, article_id, promo_id,
    header_start, header_end, tobacco_floor_price,
    round(lo + (hi - lo) * {_unit('tobacco_floor_breach', 'article_id')}, 2) AS promo_price
  FROM (
    SELECT t.article_id, t.tobacco_floor_price, t.tobacco_floor_price * 0.97::DOUBLE AS hi,
      CASE WHEN t.cost_price * 1.02::DOUBLE >= t.tobacco_floor_price * 0.97::DOUBLE
           THEN t.tobacco_floor_price * 0.90::DOUBLE ELSE t.cost_price * 1.02::DOUBLE END AS lo,
      coalesce((SELECT min(promo_id) FROM promotion_header h WHERE h.store_group = g.store_group),
               (SELECT min(promo_id) FROM promotion_header)) AS promo_id
    FROM {_sample('''(SELECT * FROM article_master WHERE merch_category = 'TOBACCO'
        AND status = 'active' AND article_id NOT IN (SELECT article_id FROM s02))''',
        'article_id', 0.08, 'tobacco_floor_breach')} t
    JOIN (SELECT article_id, min(store_group) AS store_group FROM listing
          WHERE (article_id, store_group) NOT IN (SELECT (article_id, store_group) FROM pairs_gone)
          GROUP BY article_id) g USING (article_id)
    WHERE t.tobacco_floor_price IS NOT NULL)
  JOIN promotion_header USING (promo_id)),
more_items AS MATERIALIZED (
  SELECT promo_item_id, promo_id, article_id, mechanic, promo_price, discount_value, multibuy_qty,
    item_start, item_end FROM promotion_item
  UNION ALL SELECT promo_item_id, promo_id, article_id, 'fixed_price', promo_price, NULL, NULL,
    header_start, header_end FROM s07),
s08 AS MATERIALIZED (SELECT t.*,
    round(a.cost_price * (0.6::DOUBLE + 0.3::DOUBLE * {_unit('margin_breach', 't.promo_item_id')}), 2)
      AS new_price
  FROM {_sample("(SELECT * FROM more_items WHERE mechanic IN ('fixed_price', 'multibuy'))",
                'promo_item_id', 0.05, 'margin_breach')} t
  JOIN article_master a USING (article_id)
  WHERE t.promo_item_id NOT IN (SELECT promo_item_id FROM s01)),
s09 AS MATERIALIZED (SELECT *, left(barcode, 12) || ((right(barcode, 1)::INT + 1 +
    {_draw('barcode_invalidity', 'article_id')} % 9) % 10) AS new_barcode
  FROM {_sample('article_master', 'article_id', 0.05, 'barcode_invalidity')}),
s10 AS MATERIALIZED (SELECT *, 'ARTDUP_' || article_id AS copy_id,
    [' - NEW', ' (Promo Pack)', ' V2', ''][({_draw('duplicate_near_duplicate', 'article_id')} % 4 + 1)::INT]
      AS suffix
  FROM {_sample(f"(SELECT * FROM article_master WHERE article_id NOT IN {_TOUCHED})",
                'article_id', 0.04, 'duplicate_near_duplicate')}),
s11 AS MATERIALIZED (SELECT *, CASE WHEN {_draw('completeness', 'article_id')} % 2 = 0
    THEN 'base_uom' ELSE 'tax_code' END AS nulled
  FROM {_sample(f"(SELECT * FROM article_master WHERE article_id NOT IN {_TOUCHED})",
                'article_id', 0.04, 'completeness')}),
s11h AS MATERIALIZED (SELECT * FROM {_sample(
    "(SELECT * FROM promotion_header WHERE promo_id NOT IN (SELECT promo_id FROM s05))",
    'promo_id', 0.03, 'completeness_header')}),
s12 AS MATERIALIZED (SELECT * FROM {_sample(
    f'''(SELECT * FROM promotion_header WHERE header_end < {TODAY}
      AND promo_id NOT IN (SELECT promo_id FROM s05) AND promo_id NOT IN (SELECT promo_id FROM s11h))''',
    'promo_id', 0.20, 'stale_status')} WHERE approval_status <> 'live')"""


def _truth(kind: str, table: str, key: str, source: str, changed: str, old: str, new: str,
           rest: str) -> str:
    return (f"SELECT 'GT' || substr(md5('{kind}:' || {key} || ':' || {source}), 1, 16) AS gt_id, "
            f"'{table}' AS table_name, {key} AS record_id, '{kind}' AS error_type, "
            f"{_q(TRUTH_SEVERITY[kind])} AS severity, {_q(TRUTH_IMPACT[kind])} AS downstream_impact, "
            f"{changed} AS field_changed, ({old})::VARCHAR AS old_value, ({new})::VARCHAR AS new_value "
            f"FROM {rest}")


_ITEM, _ART, _HEAD = "promotion_item", "article_master", "promotion_header"
_LOGS = {
    "referential_integrity": _truth("referential_integrity", _ITEM, "promo_item_id",
                                    "promo_item_id", "'article_id'", "article_id", "new_article", "s01"),
    "referential_timing": _truth("referential_timing", _ART, "article_id", "promo_item_id", "'status'",
                                 "old", "'discontinued (after promo item_start)'", "s02"),
    "listing_conflict": _truth("listing_conflict", _ITEM, "promo_item_id", "promo_item_id",
                               "'listing_row'", "'listed'", "'removed (delisted)'", "s03"),
    "header_item_date_mismatch": _truth("header_item_date_mismatch", _ITEM, "promo_item_id",
                                        "promo_item_id", "'item_end'", "item_end", "new_end", "s04"),
    "orphaned_cancelled_header": _truth("orphaned_cancelled_header", _HEAD, "promo_id", "promo_id",
                                        "'approval_status'", "approval_status",
                                        "'cancelled (items still active)'", "s05"),
    "uom_pack_mismatch": _truth("uom_pack_mismatch", _ART, "article_id", "promo_item_id", "'base_uom'",
                                "old", "new_uom", "s06"),
    "tobacco_floor_breach": _truth("tobacco_floor_breach", _ITEM, "promo_item_id", "promo_item_id",
                                   "'promo_price'", f"'floor=' || {_money('tobacco_floor_price')}",
                                   _money("promo_price"), "s07"),
    "margin_breach": _truth("margin_breach", _ITEM, "promo_item_id", "promo_item_id", "'promo_price'",
                            _money("promo_price"), _money("new_price"), "s08"),
    "barcode_invalidity": _truth("barcode_invalidity", _ART, "article_id", "article_id", "'barcode'",
                                 "barcode", "new_barcode", "s09"),
    "duplicate_near_duplicate": _truth("duplicate_near_duplicate", _ART, "copy_id", "copy_id",
                                       "'article_id'", "article_id", "copy_id", "s10"),
    "completeness": _truth("completeness", _ART, "article_id", "article_id", "nulled",
                           "CASE nulled WHEN 'base_uom' THEN base_uom ELSE tax_code END", "NULL", "s11")
    + " UNION ALL " + _truth("completeness", _HEAD, "promo_id", "promo_id", "'approval_status'",
                             "approval_status", "NULL", "s11h"),
    "stale_status": _truth("stale_status", _HEAD, "promo_id", "promo_id", "'approval_status'",
                           "approval_status", "'live'", "s12"),
}

# ---- injection by bands of one hash -----------------------------------------------------

def _in_band(low: float, rate: float, prefix: str = "") -> str:
    return (f"({prefix}b >= {round(low * 16 ** 7)} AND {prefix}b < {round((low + rate) * 16 ** 7)})")


def _banded(table: str, key: str) -> str:
    h = f"md5('7:{table}-band:' || {key})"
    return f"{_hex(h, 1)} AS b, {_hex(h, 9)} AS v"


_PAIR_BAND = f"{_hex("md5('7:listing-band:' || {t}.article_id || ':' || {g}.store_group)", 1)} < {round(0.05 * 16 ** 7)}"
_BANDED = f"""{CLEAN},
bi AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {_in_band(0, 0.06)} THEN 'fake' WHEN {_in_band(0.06, 0.06)} THEN 'late'
      WHEN {_in_band(0.12, 0.05)} THEN 'loss' ELSE 'none' END AS b)
  FROM (SELECT i.*, h.header_end, a.cost_price, l.article_id IS NOT NULL
      AND a.article_id IS NOT NULL AND {_PAIR_BAND.format(t="i", g="h")} AS in_gone,
    {_banded("promotion_item", "i.promo_item_id")}
  FROM promotion_item i LEFT JOIN promotion_header h USING (promo_id)
  LEFT JOIN article_master a ON a.article_id = i.article_id
  LEFT JOIN listing l ON l.article_id = i.article_id AND l.store_group = h.store_group)),
ba AS MATERIALIZED (SELECT a.*, u.first_start, u.packed, {_banded("article_master", "a.article_id")}
  FROM article_master a LEFT JOIN (SELECT article_id, min(item_start) AS first_start,
    bool_or(mechanic = 'multibuy') AS packed FROM bi WHERE b <> 'fake' GROUP BY article_id) u
  USING (article_id)),
bh AS MATERIALIZED (SELECT h.*, {_banded("promotion_header", "h.promo_id")},
    (SELECT max(item_end) FROM promotion_item i WHERE i.promo_id = h.promo_id) AS last_end
  FROM promotion_header h),
bt AS MATERIALIZED (SELECT 'PITTOB_' || article_id AS promo_item_id, tobacco_floor_price,
    round(lo + (tobacco_floor_price * 0.97::DOUBLE - lo) * (v::DOUBLE / 268435456.0::DOUBLE), 2)
      AS promo_price
  FROM (SELECT a.*, CASE WHEN cost_price * 1.02::DOUBLE >= tobacco_floor_price * 0.97::DOUBLE
      THEN tobacco_floor_price * 0.90::DOUBLE ELSE cost_price * 1.02::DOUBLE END AS lo FROM ba a
    WHERE {_in_band(0.35, 0.08)} AND merch_category = 'TOBACCO' AND status = 'active'
      AND tobacco_floor_price IS NOT NULL AND EXISTS (SELECT 1 FROM listing l
        WHERE l.article_id = a.article_id AND NOT ({_PAIR_BAND.format(t="l", g="l")})
          AND l.store_group IN (SELECT store_group FROM promotion_header)))),
banded_log AS MATERIALIZED (""" + " UNION ALL ".join([
    _truth("referential_integrity", _ITEM, "promo_item_id", "promo_item_id", "'article_id'", "article_id",
           "'ARTFAKE_' || promo_item_id", "bi WHERE b = 'fake'"),
    _truth("listing_conflict", _ITEM, "promo_item_id", "promo_item_id", "'listing_row'", "'listed'",
           "'removed (delisted)'", "bi WHERE in_gone AND b <> 'fake'"),
    _truth("header_item_date_mismatch", _ITEM, "promo_item_id", "promo_item_id", "'item_end'", "item_end",
           "header_end + (2 + v % 8)::INT", "bi WHERE b = 'late' AND header_end IS NOT NULL"),
    _truth("margin_breach", _ITEM, "promo_item_id", "promo_item_id", "'promo_price'", _money("promo_price"),
           _money("round(cost_price * (0.6::DOUBLE + 0.3::DOUBLE * (v::DOUBLE / 268435456.0::DOUBLE)), 2)"),
           "bi WHERE b = 'loss' AND mechanic IN ('fixed_price', 'multibuy') AND cost_price IS NOT NULL"),
    _truth("tobacco_floor_breach", _ITEM, "promo_item_id", "promo_item_id", "'promo_price'",
           f"'floor=' || {_money('tobacco_floor_price')}", _money("promo_price"), "bt"),
    _truth("referential_timing", _ART, "article_id", "article_id", "'status'", "status",
           "'discontinued (after promo item_start)'",
           f"ba WHERE {_in_band(0, 0.05)} AND first_start IS NOT NULL"),
    _truth("uom_pack_mismatch", _ART, "article_id", "article_id", "'base_uom'", "base_uom",
           "CASE WHEN v % 2 = 0 THEN 'CTN' ELSE 'PACK' END", f"ba WHERE {_in_band(0.05, 0.30)} AND packed"),
    # The clean table's barcodes are right, so the digit before the change is the right one.
    _truth("barcode_invalidity", _ART, "article_id", "article_id", "'barcode'", "barcode",
           "left(barcode, 12) || ((right(barcode, 1)::INT + 1 + v % 9) % 10)",
           f"ba WHERE {_in_band(0.43, 0.05)}"),
    _truth("duplicate_near_duplicate", _ART, "'ARTDUP_' || article_id", "'ARTDUP_' || article_id",
           "'article_id'", "article_id", "'ARTDUP_' || article_id", f"ba WHERE {_in_band(0.48, 0.04)}"),
    _truth("completeness", _ART, "article_id", "article_id",
           "CASE WHEN v % 2 = 0 THEN 'base_uom' ELSE 'tax_code' END",
           "CASE WHEN v % 2 = 0 THEN base_uom ELSE tax_code END", "NULL",
           f"ba WHERE {_in_band(0.52, 0.04)} AND CASE WHEN v % 2 = 0 THEN base_uom ELSE tax_code END IS NOT NULL"),
    _truth("orphaned_cancelled_header", _HEAD, "promo_id", "promo_id", "'approval_status'", "approval_status",
           "'cancelled (items still active)'", f"bh WHERE {_in_band(0, 0.25)} "
           f"AND approval_status IN ('live', 'approved') AND last_end >= {TODAY}"),
    _truth("completeness", _HEAD, "promo_id", "promo_id", "'approval_status'", "approval_status", "NULL",
           f"bh WHERE {_in_band(0.25, 0.03)} AND approval_status IS NOT NULL"),
    _truth("stale_status", _HEAD, "promo_id", "promo_id", "'approval_status'", "approval_status", "'live'",
           f"bh WHERE {_in_band(0.28, 0.20)} AND header_end < {TODAY} "
           "AND approval_status IS DISTINCT FROM 'live'")]) + ")"

_CORRUPT = f"""{_INJECT},
truth AS MATERIALIZED ({" UNION ALL ".join(_LOGS.values())}),
x_article_master AS MATERIALIZED (
  SELECT a.article_id, a.article_description, a.article_type, a.parent_article_id, a.merch_category,
    a.sub_category,
    CASE WHEN n.nulled = 'base_uom' THEN NULL ELSE coalesce(u.new_uom, a.base_uom) END AS base_uom,
    coalesce(b.new_barcode, a.barcode) AS barcode,
    CASE WHEN n.nulled = 'tax_code' THEN NULL ELSE a.tax_code END AS tax_code,
    a.list_price, a.cost_price, a.tobacco_floor_price,
    CASE WHEN d.new_date IS NULL THEN a.status ELSE 'discontinued' END AS status,
    coalesce(d.new_date, a.discontinued_date) AS discontinued_date, a.created_date, a.last_modified_date
  FROM article_master a
  LEFT JOIN (SELECT article_id, arg_max(new_date, hs) AS new_date FROM s02 GROUP BY 1) d USING (article_id)
  LEFT JOIN (SELECT DISTINCT article_id, new_uom FROM s06) u USING (article_id)
  LEFT JOIN s09 b USING (article_id) LEFT JOIN s11 n USING (article_id)
  UNION ALL SELECT copy_id, article_description || suffix, article_type, parent_article_id,
    merch_category, sub_category, base_uom, barcode, tax_code, list_price, cost_price,
    tobacco_floor_price, status, discontinued_date, {TODAY}, {TODAY} FROM s10),
x_promotion_item AS MATERIALIZED (
  SELECT i.promo_item_id, i.promo_id, coalesce(f.new_article, i.article_id) AS article_id, i.mechanic,
    coalesce(p.new_price, i.promo_price) AS promo_price, i.discount_value, i.multibuy_qty, i.item_start,
    coalesce(e.new_end, i.item_end)::DATE AS item_end
  FROM more_items i LEFT JOIN s01 f USING (promo_item_id) LEFT JOIN s04 e USING (promo_item_id)
  LEFT JOIN s08 p USING (promo_item_id)),
x_promotion_header AS MATERIALIZED (
  SELECT promo_id, promo_theme, header_start, header_end, store_group,
    CASE WHEN promo_id IN (SELECT promo_id FROM s05) THEN 'cancelled'
         WHEN promo_id IN (SELECT promo_id FROM s11h) THEN NULL
         WHEN promo_id IN (SELECT promo_id FROM s12) THEN 'live' ELSE approval_status END
      AS approval_status, created_by, created_date
  FROM promotion_header),
x_listing AS MATERIALIZED (SELECT l.* FROM listing l ANTI JOIN pairs_gone g
  ON g.article_id = l.article_id AND g.store_group = l.store_group)"""

_ACTUAL = f"""actual AS MATERIALIZED (
  SELECT 'referential_integrity' AS error_type, promo_item_id AS key FROM x_promotion_item i
    WHERE NOT EXISTS (SELECT 1 FROM x_article_master a WHERE a.article_id = i.article_id)
  UNION SELECT 'referential_timing', article_id FROM x_promotion_item JOIN x_article_master
    USING (article_id) WHERE status = 'discontinued' AND discontinued_date < item_start
  UNION SELECT 'listing_conflict', promo_item_id FROM x_promotion_item i
    JOIN x_promotion_header h USING (promo_id) JOIN x_article_master a USING (article_id)
    WHERE NOT EXISTS (SELECT 1 FROM x_listing l WHERE l.article_id = i.article_id
                      AND l.store_group = h.store_group)
  UNION SELECT 'header_item_date_mismatch', promo_item_id FROM x_promotion_item
    JOIN x_promotion_header USING (promo_id) WHERE item_start < header_start OR item_end > header_end
  UNION SELECT 'orphaned_cancelled_header', promo_id FROM x_promotion_header
    WHERE approval_status = 'cancelled'
  UNION SELECT 'uom_pack_mismatch', article_id FROM x_promotion_item JOIN x_article_master
    USING (article_id) WHERE mechanic = 'multibuy' AND base_uom <> 'EA'
  UNION SELECT 'tobacco_floor_breach', promo_item_id FROM x_promotion_item JOIN x_article_master
    USING (article_id) WHERE promo_price < tobacco_floor_price
  UNION SELECT 'margin_breach', promo_item_id FROM x_promotion_item JOIN x_article_master
    USING (article_id) WHERE mechanic IN ('fixed_price', 'multibuy') AND promo_price < cost_price
  UNION SELECT 'barcode_invalidity', article_id FROM x_article_master
    WHERE NOT coalesce({_ean('barcode')}, FALSE)
  UNION SELECT 'completeness', article_id FROM x_article_master
    WHERE base_uom IS NULL OR tax_code IS NULL
  UNION SELECT 'completeness', promo_id FROM x_promotion_header WHERE approval_status IS NULL
  UNION SELECT 'stale_status', promo_id FROM x_promotion_header
    WHERE approval_status = 'live' AND header_end < {TODAY}
  UNION SELECT 'duplicate_near_duplicate', article_id FROM x_article_master
    WHERE article_id IN (SELECT record_id FROM truth WHERE error_type = 'duplicate_near_duplicate'))"""

_SCORED = f"""{_CORRUPT}, {_worklist('x_')},
found AS MATERIALIZED (SELECT DISTINCT
    CASE WHEN w.error_type = 'tobacco_on_promotion' THEN 'tobacco_floor_breach' ELSE w.error_type END
      AS error_type,
    CASE WHEN w.error_type IN ('referential_timing', 'uom_pack_mismatch') THEN coalesce(i.article_id, w.record_id)
         WHEN w.error_type = 'orphaned_cancelled_header' THEN coalesce(i.promo_id, w.record_id)
         ELSE w.record_id END AS key
  FROM x_worklist w LEFT JOIN x_promotion_item i ON i.promo_item_id = w.record_id),
logged AS MATERIALIZED (SELECT DISTINCT error_type, record_id AS key FROM truth),
card AS MATERIALIZED (
  SELECT error_type, ground_truth, found, "TP", found - "TP" AS "FP", ground_truth - "TP" AS "FN",
    round("TP" / nullif(found, 0), 3) AS precision, round("TP" / nullif(ground_truth, 0), 3) AS recall
  FROM (SELECT coalesce(f.error_type, l.error_type) AS error_type, count(l.key) AS ground_truth,
      count(f.key) AS found, count(*) FILTER (l.key IS NOT NULL AND f.key IS NOT NULL) AS "TP"
    FROM found f FULL JOIN logged l ON f.error_type = l.error_type AND f.key = l.key GROUP BY 1))"""


# ---- derived tables ---------------------------------------------------------------------

def _h42(tag: str, *keys: str) -> str:
    return f"md5('42:{tag}:' || " + " || ':' || ".join(keys) + ")"


_WEEKS = """weeks AS MATERIALIZED (
  SELECT o_orderkey, day, thursday, thursday + (7 * (o_orderkey % 4 + 1) - 1)::INT AS last_day
  FROM (SELECT o_orderkey, o_orderdate::DATE AS day,
      o_orderdate::DATE + ((11 - isodow(o_orderdate::DATE)) % 7)::INT AS thursday FROM orders))"""

_POOL = """pool AS MATERIALIZED (SELECT * FROM article_master WHERE status = 'active'
    AND merch_category IN ('FUEL', 'DRINKS_COLD', 'FOOD_TO_GO', 'CONFECTIONERY')),
eligible AS MATERIALIZED (SELECT DISTINCT l.store_group, l.article_id
  FROM listing l JOIN pool p USING (article_id)),
sizes AS MATERIALIZED (SELECT store_group, count(*) AS n FROM eligible GROUP BY 1)"""

_PICKS = f"""{DIRTY}, {_POOL},
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY store_group
    ORDER BY {_h42('eligible', 'store_group', 'article_id')}) - 1 AS ordinal FROM eligible),
picks AS MATERIALIZED (
  SELECT q.promo_id, q.store_group, e.article_id, q.slot, q.header_start, q.header_end
  FROM (SELECT *, unnest(range(0, least(n, 2 + {_hex('hp', 1)} % 5))) AS slot
        FROM (SELECT *, {_h42('pick', 'promo_id')} AS hp
              FROM promotion_header JOIN sizes USING (store_group))) q
  JOIN numbered e ON e.store_group = q.store_group AND e.ordinal = ({_hex('q.hp', 8)} + q.slot) % q.n)"""

_PRICED = f"""{_PICKS},
drawn AS MATERIALIZED (
  SELECT k.*, a.list_price, list_price::DECIMAL(12,2) AS lp, cost_price::DECIMAL(12,2) AS cp, hq,
    CASE WHEN m = 'multibuy' AND base_uom IS DISTINCT FROM 'EA' THEN 'fixed_price' ELSE m END AS mechanic,
    2 + {_hex('hq', 22)} % 2 AS qty, ({_hex('hq', 15)} % 1001 / 1000)::DECIMAL(4,3) AS u,
    [10, 15, 20, 25][({_hex('hq', 8)} % 4 + 1)::INT] AS step
  FROM (SELECT *, ['fixed_price', 'percent_off', 'dollar_off', 'multibuy'][({_hex('hq', 1)} % 4 + 1)::INT] AS m
        FROM (SELECT *, {_h42('price', 'promo_id', 'article_id')} AS hq FROM picks)) k
  JOIN article_master a USING (article_id)),
priced AS MATERIALIZED (
  SELECT *, CASE mechanic
      WHEN 'fixed_price' THEN round(cp * 1.02 + (lp * 0.95 - cp * 1.02) * u, 2)::DOUBLE
      WHEN 'multibuy' THEN round(lp * qty::DECIMAL(1,0) * (0.75 + 0.15 * u), 2)::DOUBLE END AS promo_price,
    CASE mechanic WHEN 'percent_off' THEN (CASE WHEN lp * (100 - step) < cp * 100 THEN 10 ELSE step END)::DOUBLE
      WHEN 'dollar_off' THEN round(0.50 + (greatest(0.50, lp - cp - 0.50) - 0.50) * u, 2)::DOUBLE END
      AS discount_value,
    CASE mechanic WHEN 'multibuy' THEN qty::INT END AS multibuy_qty
  FROM drawn)"""

_WINDOWS = f"""{_PICKS},
windows_ AS MATERIALIZED (
  SELECT promo_id, article_id, header_start, header_end AS item_end, CASE WHEN w > 1 AND {_hex('hw', 1)} % 100 < 15
    THEN header_start + (7 * (1 + {_hex('hw', 8)} % (w - 1)))::INT ELSE header_start END AS item_start
  FROM (SELECT *, (header_end - header_start + 1) // 7 AS w,
          {_h42('window', 'promo_id', 'article_id')} AS hw FROM picks))"""


# ---- all texts --------------------------------------------------------------------------

def _filtered() -> str:
    return """SELECT w.*, c."check" FROM worklist w JOIN labels_ c USING (error_type)
WHERE severity IN ('Critical', 'High')
  AND "check" IN ('Tobacco on promotion', 'Priced below cost', 'Invalid barcode')
  AND store_group IN ('SG_03', 'SG_07', 'SG_11')"""


_RANK = "CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END"


def _assertions(base: str) -> str:
    bad = {
        "promo item -> article exists":
            "promotion_item i WHERE NOT EXISTS (SELECT 1 FROM article_master a WHERE a.article_id = i.article_id)",
        "promo item -> header exists":
            "promotion_item i WHERE NOT EXISTS (SELECT 1 FROM promotion_header h WHERE h.promo_id = i.promo_id)",
        "variant -> generic parent exists":
            "article_master v WHERE v.article_type = 'variant' AND NOT EXISTS (SELECT 1 FROM article_master g "
            "WHERE g.article_type = 'generic' AND g.article_id = v.parent_article_id)",
        "barcode check-digit valid": f"article_master WHERE NOT coalesce({_ean('barcode')}, FALSE)",
        "fixed_price >= cost (no margin breach)":
            "promotion_item JOIN article_master USING (article_id) "
            "WHERE mechanic = 'fixed_price' AND promo_price < cost_price",
        "item window inside header window":
            "promotion_item i JOIN promotion_header h USING (promo_id) "
            "WHERE i.item_start < h.header_start OR i.item_end > h.header_end",
        "promoted article listed in store group":
            "promotion_item i JOIN promotion_header h USING (promo_id) WHERE NOT EXISTS (SELECT 1 FROM listing l "
            "WHERE l.article_id = i.article_id AND l.store_group = h.store_group)",
        "no tobacco articles on promo":
            "promotion_item WHERE article_id IN (SELECT article_id FROM article_master "
            "WHERE merch_category = 'TOBACCO')",
        "multibuy only on EA base_uom":
            "promotion_item JOIN article_master USING (article_id) "
            "WHERE mechanic = 'multibuy' AND base_uom IS DISTINCT FROM 'EA'",
        "required article fields populated":
            "article_master WHERE article_id IS NULL OR article_description IS NULL OR article_type IS NULL "
            "OR merch_category IS NULL OR base_uom IS NULL OR barcode IS NULL OR tax_code IS NULL "
            "OR list_price IS NULL OR cost_price IS NULL OR status IS NULL",
    }
    rows = " UNION ALL ".join(f"SELECT {n} AS nr, {_q(name)} AS assertion, count(*) AS bad_count FROM {rest}"
                              for n, (name, rest) in enumerate(bad.items(), start=1))
    return (f"WITH {base}, counted AS ({rows}), judged AS MATERIALIZED (SELECT nr, assertion, bad_count, "
            "CASE WHEN bad_count = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM counted)\n")


_GATE = """SELECT count(*) AS assertions, count(*) FILTER (status = 'FAIL') AS failed,
  coalesce(string_agg(assertion, '; ' ORDER BY assertion) FILTER (status = 'FAIL'), '') AS failed_names,
  CASE WHEN count(*) FILTER (status = 'FAIL') = 0 THEN 'clean' ELSE 'not clean' END AS status FROM judged"""

_ART_COLS = ("article_id, article_description, article_type, parent_article_id, merch_category, sub_category, "
             "base_uom, barcode, tax_code, list_price, cost_price, tobacco_floor_price, status, "
             "discontinued_date, created_date, last_modified_date")
_SIX = ("article_master", "promotion_header", "promotion_item", "listing", "article_site", "change_log")
# Tables of which only rows and keys are asked here; b10 and b11 have all their columns.
_SITE_AND_LOG = """
article_site AS (SELECT l.article_id, l.store_group FROM listing l JOIN article_master a USING (article_id)),
change_log AS (SELECT row_number() OVER () AS change_id
  FROM (SELECT article_id FROM article_master UNION ALL SELECT promo_id FROM promotion_header))"""


def _texts() -> dict[str, str]:
    out: dict[str, str] = {}
    rules = _rules()
    for n, name in enumerate(rules, start=1):
        base = DIRTY + ("," + _pairs("") if name == "duplicate_near_duplicate" else "")
        out[f"c{n:02d}_{name}"] = _with(base, rules[name])
    out["c03_listing_conflict_in_window"] = _with(DIRTY, """
SELECT promo_item_id AS record_id, 'promo_item ' || promo_item_id || ' promotes article ''' || i.article_id ||
  ''' in store_group ''' || h.store_group || ''', but the article isn''t listed there.' AS description
FROM promotion_item i JOIN promotion_header h USING (promo_id)
WHERE i.article_id IN (SELECT article_id FROM article_master) AND NOT EXISTS (SELECT 1 FROM listing l
  WHERE l.article_id = i.article_id AND l.store_group = h.store_group
    AND l.valid_from <= i.item_start AND l.valid_to >= i.item_end)""")
    out["c08_margin_breach_per_unit"] = _with(DIRTY, """
SELECT promo_item_id AS record_id FROM (SELECT *, CASE mechanic WHEN 'multibuy' THEN promo_price / multibuy_qty
        WHEN 'percent_off' THEN list_price * (1 - discount_value / 100)
        WHEN 'dollar_off' THEN list_price - discount_value ELSE promo_price END AS unit
      FROM promotion_item JOIN article_master USING (article_id)) WHERE unit < cost_price""")
    out["c10_match_counts"] = _with(
        f"{DIRTY}, {_pairs('')}",
        "SELECT record_id, first_match, round(score, 6) AS score, matches FROM matched")

    work = f"{DIRTY}, {_worklist()}"
    out["e02_worklist"] = _with(work, "SELECT * FROM worklist")
    out["e02_worklist_by_rule"] = _with(work, "SELECT * FROM flat")
    out["e03_worklist_store_group"] = _with(
        work, "SELECT * FROM worklist")
    out["e04_rule_facts"] = _with(work, """SELECT error_type, severity, "check", downstream_impact, count(*) AS n
FROM worklist JOIN labels_ USING (error_type) GROUP BY ALL""")
    out["e08_totals"] = _with(work, "SELECT 12::BIGINT AS checks, count(*) AS exceptions FROM worklist")

    for n, label in enumerate([
            "item_article_exists", "item_header_exists", "variant_parent_exists", "barcode_valid",
            "fixed_price_above_cost", "item_in_header_window", "promoted_is_listed", "no_tobacco_items",
            "multibuy_on_each", "required_populated"], start=1):
        out[f"v{n:02d}_{label}"] = (_assertions(DIRTY)
                                    + f"SELECT assertion, bad_count, status FROM judged WHERE nr = {n}")
    out["v11_gate_summary"] = _assertions(DIRTY) + _GATE
    out["v11_gate_summary_clean"] = _assertions(CLEAN) + _GATE
    keys = {"article_master": "article_id", "promotion_header": "promo_id",
            "promotion_item": "promo_item_id", "listing": "store_group, article_id",
            "article_site": "article_id, store_group", "change_log": "change_id"}
    out["v12_key_uniqueness"] = _with(f"{DIRTY}, {_SITE_AND_LOG}", " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} "
        f"HAVING count(*) > 1)) AS repeated_keys" for t, k in keys.items()))

    for n, (name, text) in enumerate(_LOGS.items(), start=1):
        out[f"j{n:02d}_{name}"] = _with(_INJECT, text)
    out["j13_corrupted_article_master"] = _with(_CORRUPT, "SELECT * FROM x_article_master")
    out["j13_corrupted_promotion_header"] = _with(_CORRUPT, "SELECT * FROM x_promotion_header")
    out["j13_corrupted_promotion_item"] = _with(_CORRUPT, "SELECT * FROM x_promotion_item")
    out["j13_corrupted_listing"] = _with(_CORRUPT, "SELECT * FROM x_listing")

    out["j00_banded_log"] = _with(_BANDED, "SELECT * FROM banded_log")
    # The defects that the corrupted tables show are those of the log.
    out["j00_banded_defects"] = _with(
        _BANDED, "SELECT DISTINCT error_type, record_id AS key FROM banded_log")
    out["k_actual_defects"] = _with(f"{_CORRUPT}, {_ACTUAL}", "SELECT * FROM actual")
    out["k_log_check"] = _with(f"{_CORRUPT}, {_ACTUAL}", """
SELECT *, CASE WHEN missing = 0 AND unlogged = 0 THEN 'OK' ELSE 'MISMATCH' END AS status FROM (
  SELECT coalesce(t.error_type, a.error_type) AS error_type, count(t.key) AS logged,
    count(*) FILTER (a.key IS NULL) AS missing, count(*) FILTER (t.key IS NULL) AS unlogged
  FROM (SELECT DISTINCT error_type, record_id AS key FROM truth) t
  FULL JOIN actual a ON a.error_type = t.error_type AND a.key = t.key GROUP BY 1)""")
    out["k07_tobacco_floor"] = _with(DIRTY, """
SELECT 'tobacco_floor_breach' AS error_type, promo_item_id AS key
FROM promotion_item JOIN article_master USING (article_id)
WHERE tobacco_floor_price IS NOT NULL AND promo_price < tobacco_floor_price""")
    out["k13_log_size"] = _with(
        _CORRUPT, "SELECT count(*) AS log_rows, count(DISTINCT error_type) AS error_types FROM truth")
    out["r_scorecard"] = _with(_SCORED, "SELECT * FROM card")
    out["r_overall"] = _with(_SCORED, """
SELECT "TP", "FP", "FN", round(p, 9) AS precision, round(r, 9) AS recall, round(2 * p * r / (p + r), 9) AS f1
FROM (SELECT *, "TP" / ("TP" + "FP") AS p, "TP" / ("TP" + "FN") AS r
  FROM (SELECT sum("TP")::BIGINT AS "TP", sum("FP")::BIGINT AS "FP", sum("FN")::BIGINT AS "FN" FROM card))""")

    out["b01_next_thursday"] = _with(_WEEKS, "SELECT o_orderkey, day AS order_day, thursday FROM weeks")
    out["b02_promotion_weeks"] = _with(_WEEKS, """SELECT o_orderkey, thursday AS header_start,
  last_day AS header_end, (last_day - thursday + 1)::INT AS days, (isodow(last_day) - 1)::INT AS last_weekday
FROM weeks""")
    out["b03_lifecycle_status"] = _with(_WEEKS, f"""SELECT o_orderkey, CASE WHEN last_day < {TODAY} THEN 'expired'
  WHEN thursday <= {TODAY} THEN 'live' WHEN o_orderkey % 5 < 2 THEN 'draft' ELSE 'approved' END AS status
FROM weeks""")
    out["b04_promotable_pool"] = _with(f"{DIRTY}, {_POOL}", "SELECT article_id, merch_category FROM pool")
    out["b05_eligible_counts"] = _with(f"{DIRTY}, {_POOL}", """
SELECT promo_id, store_group, coalesce(n, 0) AS eligible FROM promotion_header LEFT JOIN sizes USING (store_group)""")
    out["b06_picked_articles"] = _with(_PICKS, "SELECT promo_id, store_group, article_id, slot FROM picks")
    out["b07_priced_items"] = _with(_PRICED, """
SELECT promo_id, article_id, mechanic, promo_price, discount_value, multibuy_qty, round(CASE mechanic
    WHEN 'percent_off' THEN list_price * (1 - discount_value / 100)
    WHEN 'dollar_off' THEN list_price - discount_value
    WHEN 'multibuy' THEN promo_price / multibuy_qty ELSE promo_price END, 6) AS effective_unit_price FROM priced""")
    out["b08_item_windows"] = _with(
        _WINDOWS, "SELECT promo_id, article_id, header_start, item_start, item_end FROM windows_")
    out["b08_promotion_items"] = _with(_WINDOWS, f"""
SELECT printf('PIT%06d', row_number() OVER (ORDER BY {_h42('item', 'promo_id', 'article_id')}) - 1)
  AS promo_item_id, promo_id, article_id, item_start, item_end FROM windows_""")
    out["b09_listing"] = _with(DIRTY, f"""
SELECT store_group, article_id, DATE '1993-01-01' + ({_hex(_h42('since', 'article_id', 'store_group'), 1)} % 900)::INT
  AS valid_from, DATE '2099-12-31' AS valid_to
FROM (SELECT article_id, printf('SG_%02d', n_nationkey) AS store_group
  FROM (SELECT article_id, g, ({_hex('hl', 8)} + unnest(range(0,
          (g // 4) + {_hex('hl', 1)} % (g - (g // 4) + 1)))) % g AS ordinal
        FROM (SELECT article_id, {_h42('listing', 'article_id')} AS hl, (SELECT count(*) FROM nation) AS g
              FROM article_master WHERE status <> 'discontinued'))
  JOIN nation ON n_nationkey = ordinal)""")
    site = _h42("site", "l.article_id", "l.store_group")
    out["b10_article_site"] = _with(DIRTY, f"""
SELECT article_id, store_group,
  round(list_price::DECIMAL(12,2) * ((98 + {_hex('hs', 1)} % 9) / 100)::DECIMAL(4,2), 2)::DOUBLE AS site_list_price,
  TRUE AS listed, CASE WHEN {_hex('hs', 8)} % 10 = 0 THEN 'out_of_stock' ELSE 'in_stock' END AS stock_status,
  valid_from + ({_hex('hs', 15)} % 365)::INT AS last_modified_date
FROM (SELECT l.*, a.list_price, {site} AS hs FROM listing l JOIN article_master a USING (article_id))""")
    out["b11_change_log"] = _with(DIRTY, f"""
SELECT printf('CHG%07d', row_number() OVER (ORDER BY {_h42('change', 'table_name', 'record_id')}) - 1) AS change_id,
  *, 'create' AS change_type, NULL::VARCHAR AS field_changed, NULL::VARCHAR AS old_value, NULL::VARCHAR AS new_value
FROM (SELECT 'article_master' AS table_name, article_id AS record_id, 'system' AS changed_by,
        created_date AS changed_at FROM article_master
      UNION ALL SELECT 'promotion_header', promo_id, created_by, created_date FROM promotion_header)""")
    out["b12_minted_ids"] = (f"SELECT c_name, printf('ART%05d', row_number() OVER (ORDER BY {_h42('ART', 'c_name')}) - 1) "
                             "AS article_id FROM customer")
    out["b13_minted_barcodes"] = """
SELECT o_orderkey, body || ((10 - list_sum(list_transform(range(1, 13), lambda i: substr(body, i::INT, 1)::INT
    * (CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END))) % 10) % 10)::VARCHAR AS barcode
FROM (SELECT o_orderkey, '93' || lpad(o_orderkey::VARCHAR, 10, '0') AS body FROM orders)"""
    out["b14_variants"] = _with(DIRTY, f"""
SELECT article_id || '-' || (slot + 1) AS article_id,
  article_description || ' - ' || sizes[(({_hex('hv', 8)} + slot) % len(sizes) + 1)::INT] AS article_description,
  'variant' AS article_type, article_id AS parent_article_id, merch_category, sub_category, base_uom, tax_code
FROM (SELECT *, unnest(range(0, least(len(sizes), 2 + {_hex('hv', 1)} % 3))) AS slot
  FROM (SELECT *, {_h42('variants', 'article_id')} AS hv,
          CASE WHEN merch_category = 'DRINKS_COLD' THEN ['375ml', '600ml', '1.25L']
               ELSE ['Single', 'Twin', 'Family', 'Bulk'] END AS sizes
        FROM article_master WHERE article_type = 'generic'))""")

    out["d01_records_scanned"] = _with(DIRTY, """SELECT ((SELECT count(*) FROM article_master)
  + (SELECT count(*) FROM promotion_item))::BIGINT AS records_scanned""")
    out["d02_headline"] = _with(work, """SELECT count(*) AS total_exceptions,
  count(*) FILTER (severity = 'Critical') AS critical_count FROM worklist""")
    out["d03_detection_rates"] = _with(_SCORED, """
SELECT round(coalesce(sum("TP") / nullif(sum("TP") + sum("FP"), 0), 0), 9) AS precision,
  round(coalesce(sum("TP") / nullif(sum("TP") + sum("FN"), 0), 0), 9) AS recall FROM card""")
    severities = ("(SELECT unnest([0, 1, 2, 3]) AS severity_rank, "
                  "unnest(['Critical', 'High', 'Medium', 'Low']) AS severity)")
    out["d04_severity_counts"] = _with(work, f"""SELECT severity_rank, severity, count(record_id) AS n
FROM {severities} LEFT JOIN worklist USING (severity) GROUP BY ALL""")
    out["d05_type_counts"] = _with(work, """SELECT error_type, severity, "check", count(*) AS n
FROM worklist JOIN labels_ USING (error_type) GROUP BY ALL""")
    groups = "SELECT store_group, count(*) AS n FROM worklist WHERE store_group IS NOT NULL GROUP BY 1"
    out["d06_group_counts"] = _with(work, groups)
    out["d07_group_summary"] = _with(work, f"""SELECT count(*) AS groups, max(n) AS worst,
  floor(median(n))::BIGINT AS median FROM ({groups})""")
    out["d08_worst_groups"] = _with(work, f"{groups} ORDER BY n DESC, store_group LIMIT 10")
    out["d09_filtered"] = _with(work, _filtered())
    out["d10_in_order"] = _with(work, f"""SELECT ({_RANK})::INT AS severity_rank, "check", worklist.*
FROM worklist JOIN labels_ USING (error_type)""")
    out["d11_worklist_view"] = _with(work, """SELECT severity, "check", table_name, record_id, store_group,
  downstream_impact, description FROM worklist JOIN labels_ USING (error_type)""")
    out["d11_shown_of_total"] = _with(work, f"""SELECT (SELECT count(*) FROM ({_filtered()})) AS shown,
  (SELECT count(*) FROM worklist) AS total""")
    names = " ".join(f"WHEN {_q(n)} THEN {_q(LABEL[n])}" for n in LABEL)
    out["d12_scorecard_view"] = _with(_SCORED, f"""
SELECT CASE error_type WHEN 'tobacco_floor_breach' THEN 'Tobacco on promotion' {names} ELSE error_type END AS "Check",
  ground_truth AS "Injected", found AS "Detected", "TP", "FP", "FN", precision AS "Precision", recall AS "Recall"
FROM card""")
    out["d13_filter_options"] = _with(work, """
SELECT DISTINCT 'check' AS filter, "check" AS option FROM worklist JOIN labels_ USING (error_type)
UNION ALL SELECT DISTINCT 'store_group', store_group FROM worklist WHERE store_group IS NOT NULL""")
    out["d14_bar_widths"] = _with(work, """SELECT severity, n, round(n / max(n) OVER () * 100, 6) AS width
FROM (SELECT severity, count(*) AS n FROM worklist GROUP BY 1)""")
    out["d15_log_counts"] = _with(
        _CORRUPT, "SELECT error_type, severity, count(*) AS n FROM truth GROUP BY ALL")

    out["f01_ean13"] = _with(DIRTY, f"""
SELECT article_id, form, coalesce({_ean('code')}, FALSE) AS valid
FROM (SELECT article_id, unnest([0, 1, 2, 3, 4, 5]) AS form, unnest([barcode, left(barcode, 12), barcode || '0',
        barcode || chr(10), left(barcode, 4) || 'X' || substr(barcode, 6), NULL]) AS code FROM article_master)""")
    out["f02_similar_descriptions"] = _with(f"""{DIRTY},
one_each AS (SELECT *, row_number() OVER (PARTITION BY merch_category, list_sort(list_distinct(
    regexp_split_to_array(article_description, '\\s+'))) ORDER BY article_id) AS nr FROM article_master),
d_article_master AS (SELECT article_id, NULL::VARCHAR AS parent_article_id, merch_category, article_description
  FROM one_each WHERE nr = 1), {_pairs('d_')}""", """
SELECT cat AS category, least(na, nb) AS text_low, greatest(na, nb) AS text_high, round(score, 6) AS score
FROM d_near""")
    out["f05_parsed_dates"] = """
SELECT o_orderkey, text, try_cast(text AS DATE) AS day FROM (SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN 'n/a ' ELSE '' END || o_orderdate::DATE AS text FROM orders)"""
    out["f10_formats"] = """
SELECT l_orderkey, quantity::DECIMAL(12,2)::VARCHAR AS money, round_even(quantity / 2, 0)::BIGINT::VARCHAR AS whole,
  (n / 8 * 100)::DECIMAL(12,1)::VARCHAR || '%' AS percent
FROM (SELECT l_orderkey, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem GROUP BY 1)"""

    six = f"{DIRTY}, {_SITE_AND_LOG}"
    counts = {t: f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _SIX}
    widths = {"article_master": 16, "promotion_header": 8, "promotion_item": 9, "listing": 4,
              "article_site": 6, "change_log": 9}
    out["s01_table_rows"] = _with(six, " UNION ALL ".join(counts.values()))
    out["s03_csv_tables"] = _with(six, " UNION ALL ".join(counts.values()))
    out["s03_csv_round_trip"] = _with(DIRTY, f"SELECT {_ART_COLS} FROM article_master")
    out["s04_schema_check"] = _with(six, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {widths[t]}::BIGINT AS columns, count(*) AS n FROM {t}" for t in _SIX))
    out["s06_scorecard_sink"] = out["r_scorecard"]
    out["s07_truth_log_sink"] = _with(_INJECT, " UNION ALL ".join(f"SELECT * FROM ({t})" for t in _LOGS.values()))
    out["s09_exported_view"] = out["d11_worklist_view"]
    some = "error_type IN ('barcode_invalidity', 'stale_status', 'uom_pack_mismatch')"
    clean_six = f"{CLEAN}, {_SITE_AND_LOG}"
    out["s08_clean_tables"] = _with(clean_six, " UNION ALL ".join(counts.values()))
    out["s10_missing_inputs"] = _with(work, f"""
SELECT 'exceptions' AS input, count(*) AS n, FALSE AS missing FROM worklist WHERE {some}
UNION ALL SELECT unnest(['ground_truth', 'scorecard']), NULL, TRUE""")
    out["s11_rejected_values"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::DATE END AS day,
  CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 50)::INT END AS lines,
  nullif(concat_ws(';', CASE WHEN o_orderkey % 7 = 0 THEN 'day=n/a ' || o_orderdate::DATE END,
                   CASE WHEN o_orderkey % 11 = 0 THEN 'lines=many' END), '') AS rejected
FROM orders"""
    out["s12_rerun_partitions"] = _with(work, f"SELECT * FROM worklist WHERE {some}")
    severities = ", ".join(f"count(*) FILTER (severity = '{s}') AS n_{s.lower()}"
                           for s in ("Critical", "High", "Medium", "Low"))
    out["d16_observed_totals"] = _with(work, f"""
SELECT count(*) AS total_exceptions, {severities} FROM worklist WHERE {some}""")
    out["d17_distinct_records"] = _with(work, """
SELECT error_type, count(DISTINCT record_id) AS records, TRUE AS "close" FROM worklist GROUP BY error_type""")
    out["s05_worklist_sink"] = _with(work, "SELECT * FROM worklist")
    return out


ORACLES = _texts()
