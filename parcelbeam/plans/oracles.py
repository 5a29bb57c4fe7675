"""DuckDB oracle SQL, one statement per driver query.

Written independently of the Spark code path: the stand-in views are
restated as CTEs, and the statistics use the textbook forms (``median``,
``avg(abs(r - m))``, ``ntile``, ``row_number``, ``regr_slope``, a literal
fan-out join for the joined-row count) instead of the distributed ranks
the Spark side uses.  Hygiene: integer sums cast to BIGINT, NaN from
``regr_slope`` mapped to NULL, ``||`` for NULL-propagating concatenation,
``x / nullif(y, 0)`` for Spark's ``try_divide``.
"""

from __future__ import annotations

# Parameters -- must equal parcelbeam.plans.queries.
MAIL_YEAR = 2000
MIN_YEAR = "1999"

WS = ("[\\x{0009}-\\x{000D}\\x{0020}\\x{0085}\\x{00A0}\\x{1680}"
      "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")


def _pin(key: str) -> str:
    return f"(lpad(CAST({key} // 10 AS VARCHAR), 10, '0') || lpad(CAST({key} % 10 AS VARCHAR), 4, '0'))"


def _pretty14(p: str) -> str:
    return (f"(substr({p},1,2) || '-' || substr({p},3,2) || '-' || substr({p},5,3) || '-' || "
            f"substr({p},8,3) || '-' || substr({p},11,4))")


def _pretty10(p: str) -> str:
    return f"(substr({p},1,2) || '-' || substr({p},3,2) || '-' || substr({p},5,3) || '-' || substr({p},8,3))"


def _clean(x: str) -> str:
    return f"replace(regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g'), '-', '')"


def _numtext(x: str) -> str:
    return f"coalesce(regexp_replace(CAST(TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR), '\\.?0+$', ''), 'NA')"


def _bits(x: str) -> str:
    return f"hex(CAST(CAST({x} AS BIT) AS BLOB))"


def _fin(x: str) -> str:
    return f"(CASE WHEN isfinite({x}) THEN {x} END)"


def _thousands(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN format('{{:,}}', CAST({x} AS BIGINT)) END"


def _dollar(x: str) -> str:
    r = f"round({x})"
    return f"(CASE WHEN {r} < 0 THEN '-$' || {_thousands(f'-{r}')} ELSE '$' || {_thousands(r)} END)"


MODEL = ("CASE WHEN ss.o_orderkey IS NULL OR ss.o_orderkey % 5 = 0 THEN CAST(50000 + (pb.c_custkey % 1000) * 150 AS DOUBLE) "
         "WHEN ss.o_orderkey % 997 = 0 THEN NULL "
         "ELSE CAST((CAST(round(ss.o_totalprice) AS BIGINT) * (80 + ss.o_orderkey % 41)) // 100 AS DOUBLE) END")

BASE = f"""
pb AS (
  SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, {_pin('c.c_custkey')} AS pin,
         CAST(n.n_nationkey AS VARCHAR) AS township_code, replace(n.n_name, '_', ' ') AS township_name,
         CASE WHEN c.c_custkey % 17 <> 5 THEN lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') || '-' || substr(c.c_mktsegment, 1, 3) END AS nbhd_code,
         r.r_name AS triad_name, 'run-' || lower(r.r_name) AS run_id
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
uni_years AS (
  SELECT pb.*, '1999' AS year FROM pb
  UNION ALL SELECT pb.*, '2000' FROM pb WHERE c_acctbal >= 0
  UNION ALL SELECT pb.*, '1998' FROM pb WHERE c_mktsegment = 'BUILDING'),
uni AS (
  SELECT pin, substr(pin, 1, 10) AS pin10, year,
    CASE WHEN c_custkey % 331 = 3 THEN CAST('NaN' AS DOUBLE)
      WHEN NOT (c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0) THEN CAST(-87.95 + (c_custkey % 997) * 0.00050000123 AS DOUBLE) END AS lon,
    CASE WHEN NOT (c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 0) THEN CAST(41.60 + (c_custkey % 499) * 0.00100000321 AS DOUBLE) END AS lat,
    township_name, nbhd_code, triad_name
  FROM uni_years)"""

CHARS = """
chars AS (
  SELECT pin, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(CAST(y.year AS INTEGER) - 10 AS VARCHAR) ELSE y.year END AS year, CAST(20000 + ((c_custkey // 10) % 50) * 1000 AS BIGINT) AS building_sf,
    CAST(600 + (c_custkey % 37) * 25 AS BIGINT) AS unit_sf, CAST(c_custkey % 4 + 1 AS BIGINT) AS bedrooms,
    CAST(c_custkey % 3 + 1 AS BIGINT) AS full_baths, CAST(c_custkey % 2 AS BIGINT) AS half_baths,
    CASE WHEN c_custkey % 10 = 9 THEN substr(pin, 1, 10) || '0000' END AS parking_pin
  FROM pb CROSS JOIN (VALUES ('1999'), ('2000')) y(year))"""

PERMITS = f"""
permits AS (
  SELECT {_pin('user_id')} AS pin, CAST(1995 + event_id % 7 AS VARCHAR) AS assessment_year,
    'P' || CAST(event_id AS VARCHAR) AS permit_number, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_issued,
    'Work ' || props AS work_description
  FROM events)"""

STATUS = """
status AS (
  SELECT pin, CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(CAST(y.year AS INTEGER) - 10 AS VARCHAR) ELSE y.year END AS year, c_custkey % 10 = 9 AS is_parking_space,
    CASE WHEN c_custkey % 10 = 9 THEN 'deeded parking space' END AS parking_space_flag_reason,
    c_custkey % 10 = 0 AS is_common_area
  FROM pb CROSS JOIN (VALUES ('1999'), ('2000')) y(year))"""

SALES = f"""
sales AS (
  SELECT {_pin('o_custkey')} AS pin, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(o_orderkey AS VARCHAR) AS doc_no,
    CAST(o_orderdate AS DATE) AS sale_date, CAST(round(o_totalprice) AS BIGINT) AS sale_price,
    o_orderstatus = 'F' AS sv_is_outlier
  FROM orders)"""

ADDR = """
addr AS (
  SELECT pin, '2000' AS year,
    CASE c_custkey % 5 WHEN 0 THEN CAST(100 + c_custkey % 900 AS VARCHAR) || ' N Élm St.'
                       WHEN 1 THEN CAST(100 + c_custkey % 900 AS VARCHAR) || ' W Oak-Park Ave'
                       WHEN 2 THEN CAST(100 + c_custkey % 900 AS VARCHAR) || ' S Main St #2'
                       WHEN 3 THEN CAST(100 + c_custkey % 900 AS VARCHAR) || ' E Lake Shore Dr' END AS prop_address_full,
    CASE c_custkey % 3 WHEN 0 THEN 'CHICAGO' WHEN 1 THEN 'Évanston' END AS prop_address_city_name,
    CAST(60600 + c_custkey % 50 AS VARCHAR) AS prop_address_zipcode_1,
    CASE WHEN c_custkey % 10 = 0 THEN '' ELSE 'U' || CAST(c_custkey % 10 AS VARCHAR) END AS prop_address_unit_number
  FROM pb)"""

HIST = f"""
roles AS (
  SELECT o_custkey, CAST(round(o_totalprice) AS BIGINT) AS v, year(o_orderdate) AS yr, 'mailed' AS role FROM orders
  UNION ALL SELECT o_custkey, CAST(round(o_totalprice) AS BIGINT), year(o_orderdate) + 1, 'oneyr' FROM orders
  UNION ALL SELECT o_custkey, CAST(round(o_totalprice) AS BIGINT), year(o_orderdate) + 2, 'twoyr' FROM orders),
hist AS (
  SELECT {_pin('o_custkey')} AS pin, CAST(yr AS VARCHAR) AS year, CAST(202 + o_custkey % 98 AS VARCHAR) AS class,
    CAST(sum(CASE WHEN role = 'twoyr' THEN v END) AS BIGINT) AS twoyr_pri_certified_tot,
    CAST(sum(CASE WHEN role = 'oneyr' THEN v END) AS BIGINT) AS oneyr_pri_certified_tot,
    CAST(sum(CASE WHEN role = 'mailed' THEN v END) AS BIGINT) AS mailed_tot
  FROM roles GROUP BY o_custkey, yr)"""

REQ = f"""
req AS (
  SELECT CASE c_custkey % 4 WHEN 0 THEN {_pretty14('pin')}
                            WHEN 1 THEN chr(160) || {_pretty14('pin')} || chr(9)
                            WHEN 2 THEN ' ' || pin || chr(12288)
                            ELSE pin END AS "Permanent Index Number",
    c_name AS "Owner Name", substr(c_mktsegment, 1, 3) AS "class", 'requests_' || lower(c_mktsegment) || '.csv' AS source_file
  FROM pb)"""

QC = f"""
qc AS (
  SELECT {_pretty14('pin')} AS "14-Digit PIN",
    CASE c_custkey % 3 WHEN 0 THEN 'Unit SF looks low' WHEN 1 THEN 'Bedroom count mismatch' ELSE 'Check parking' END AS "Flag Comments"
  FROM pb WHERE c_acctbal < 0),
flagged AS (SELECT {_clean('"14-Digit PIN"')} AS pin, "Flag Comments" AS qc_flag FROM qc)"""

MODELS = f"""
ss AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
fm AS (
  SELECT 'run-' || lower(r_name) AS run_id, '2000' AS year, 'res' AS type,
    list_sort(list(CAST(n_nationkey AS VARCHAR))) AS township_code_coverage
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name),
ap AS (
  SELECT pb.run_id, pb.township_code, pb.pin AS meta_pin, {MODEL} AS pred_pin_final_fmv_round,
    CASE WHEN ss.o_orderkey % 5 = 0 THEN NULL WHEN ss.o_orderkey % 311 = 0 THEN 0 WHEN ss.o_orderkey % 313 = 0 THEN NULL
      ELSE round(ss.o_totalprice) END AS sale_ratio_study_price, CAST(ss.o_orderdate AS DATE) AS sale_ratio_study_date,
    CAST(ss.o_orderkey AS VARCHAR) AS sale_ratio_study_document_num
  FROM pb LEFT JOIN ss ON pb.c_custkey = ss.o_custkey),
desk1 AS (
  SELECT pb.c_custkey, pb.pin AS "PIN", CAST((CAST({MODEL} AS BIGINT) * (90 + pb.c_custkey % 21)) // 100 AS DOUBLE) AS "Desk Review Value",
    pb.township_code || '-' || replace(pb.township_name, ' ', '_') AS sheet
  FROM pb LEFT JOIN ss ON pb.c_custkey = ss.o_custkey),
desk AS (
  SELECT "PIN", "Desk Review Value", sheet || '.csv' AS source_file FROM desk1
  UNION ALL SELECT "PIN", "Desk Review Value" + 1000, sheet || ' again.csv' FROM desk1 WHERE c_custkey % 101 = 7),
fms AS (SELECT run_id, unnest(township_code_coverage) AS township_code FROM fm WHERE year = '2000' AND type = 'res'),
mv AS (
  SELECT ap.meta_pin AS pin, ap.pred_pin_final_fmv_round AS model_value, ap.sale_ratio_study_price AS sale_price,
    ap.sale_ratio_study_date AS sale_date, ap.sale_ratio_study_document_num AS sale_document_number
  FROM ap JOIN fms ON ap.run_id = fms.run_id AND ap.township_code = fms.township_code),
mrp AS (
  SELECT pin, year, township_name, nbhd_code AS neighborhood_number FROM (
    SELECT *, row_number() OVER (PARTITION BY pin ORDER BY year DESC) AS rn FROM uni WHERE year IN ('1999', '2000'))
  WHERE rn = 1),
dr AS (SELECT {_clean('"PIN"')} AS pin, CAST("Desk Review Value" AS DOUBLE) AS desk_review_value FROM desk),
parcels AS (
  SELECT dr.pin, dr.desk_review_value, x.year, x.township_name, x.neighborhood_number, x.model_value,
    x.sale_price, x.sale_date, x.sale_document_number
  FROM dr LEFT JOIN (SELECT mrp.*, mv.model_value, mv.sale_price, mv.sale_date, mv.sale_document_number
                     FROM mrp LEFT JOIN mv ON mrp.pin = mv.pin) x ON dr.pin = x.pin),
rp AS (
  SELECT *,
    CASE WHEN sale_price = 0 THEN CASE WHEN model_value > 0 THEN CAST('inf' AS DOUBLE) END ELSE model_value / sale_price END AS model_sale_ratio,
    CASE WHEN sale_price = 0 THEN CASE WHEN desk_review_value > 0 THEN CAST('inf' AS DOUBLE) END
      ELSE desk_review_value / sale_price END AS desk_review_sale_ratio
  FROM parcels WHERE township_name IS NOT NULL),
dec AS (
  SELECT *,
    CASE WHEN sale_price IS NOT NULL THEN row_number() OVER (PARTITION BY township_name, sale_price IS NULL ORDER BY sale_price, pin, desk_review_value) END AS price_rank,
    CASE WHEN sale_price IS NOT NULL THEN CAST(ntile(10) OVER (PARTITION BY township_name, sale_price IS NULL ORDER BY sale_price, pin, desk_review_value) AS INTEGER) END AS price_decile
  FROM rp),
lng AS (
  SELECT township_name, price_decile, pin, sale_price, price_rank, 'model' AS stage, model_value AS assessed, model_sale_ratio AS ratio
  FROM dec WHERE sale_price IS NOT NULL
  UNION ALL
  SELECT township_name, price_decile, pin, sale_price, price_rank, 'desk_review', desk_review_value, desk_review_sale_ratio
  FROM dec WHERE sale_price IS NOT NULL)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


RATIO_CTES = _with(BASE, MODELS)

TOWN_STATS = RATIO_CTES + f"""
, med AS (SELECT stage, township_name, count(*) AS n_rows, count(ratio) AS n_values, median(ratio) AS m
          FROM lng GROUP BY stage, township_name),
st AS (
  SELECT l.stage, l.township_name,
    CASE WHEN med.n_values = med.n_rows THEN med.m END AS median,
    CASE WHEN med.n_values = med.n_rows THEN 100 * avg(abs(l.ratio - med.m)) / nullif(med.m, 0) END AS cod,
    CASE WHEN med.n_values = med.n_rows THEN avg(l.ratio) / nullif(sum(l.assessed) / nullif(sum(l.sale_price), 0), 0) END AS prd,
    CASE WHEN med.n_values = med.n_rows AND NOT bool_or(isinf(l.ratio)) THEN regr_slope((l.ratio - med.m) / nullif(med.m, 0),
      log2(0.5 * (l.assessed / nullif(med.m, 0) + l.sale_price))) FILTER (WHERE isfinite(l.ratio)) END AS prb_raw,
    CASE WHEN med.n_values = med.n_rows THEN
      ((2 * sum(l.price_rank * l.assessed) / sum(l.assessed) - (count(*) + 1)) / count(*))
      / nullif((2 * sum(l.price_rank * l.sale_price) / sum(l.sale_price) - (count(*) + 1)) / count(*), 0) END AS mki
  FROM lng l JOIN med USING (stage, township_name)
  GROUP BY l.stage, l.township_name, med.n_values, med.n_rows, med.m),
st2 AS (SELECT *, CASE WHEN isnan(prb_raw) THEN NULL ELSE prb_raw END AS prb FROM st),
wide AS (
  SELECT township_name,
    {_fin("round(max(CASE WHEN stage = 'model' THEN median END), 6)")} AS model_ratio,
    {_fin("round(max(CASE WHEN stage = 'model' THEN cod END), 6)")} AS model_cod,
    {_fin("round(max(CASE WHEN stage = 'model' THEN prd END), 6)")} AS model_prd,
    round(max(CASE WHEN stage = 'model' THEN prb END), 6) AS model_prb,
    round(max(CASE WHEN stage = 'model' THEN mki END), 6) AS model_mki,
    {_fin("round(max(CASE WHEN stage = 'desk_review' THEN median END), 6)")} AS desk_review_ratio,
    {_fin("round(max(CASE WHEN stage = 'desk_review' THEN cod END), 6)")} AS desk_review_cod,
    {_fin("round(max(CASE WHEN stage = 'desk_review' THEN prd END), 6)")} AS desk_review_prd,
    round(max(CASE WHEN stage = 'desk_review' THEN prb END), 6) AS desk_review_prb,
    round(max(CASE WHEN stage = 'desk_review' THEN mki END), 6) AS desk_review_mki
  FROM st2 GROUP BY township_name),
prices AS (
  SELECT township_name, {_dollar('min(sale_price)')} || '-' || {_dollar('max(sale_price)')} AS price_range,
    count(*) AS number_of_sales
  FROM dec WHERE sale_price IS NOT NULL GROUP BY township_name)
SELECT wide.*, prices.price_range, prices.number_of_sales FROM wide JOIN prices USING (township_name)
"""

DECILES_BODY = f"""
, dmed AS (SELECT stage, township_name, price_decile, count(*) AS n_rows, count(ratio) AS n_values, median(ratio) AS m
           FROM lng GROUP BY ALL),
dst AS (
  SELECT l.stage, l.township_name, l.price_decile,
    CASE WHEN d.n_values = d.n_rows THEN d.m END AS median,
    CASE WHEN d.n_values = d.n_rows THEN 100 * avg(abs(l.ratio - d.m)) / nullif(d.m, 0) END AS cod
  FROM lng l JOIN dmed d USING (stage, township_name, price_decile)
  GROUP BY l.stage, l.township_name, l.price_decile, d.n_values, d.n_rows, d.m),
dwide AS (
  SELECT township_name, price_decile,
    {_fin("round(max(CASE WHEN stage = 'model' THEN median END), 6)")} AS model_ratio,
    {_fin("round(max(CASE WHEN stage = 'model' THEN cod END), 6)")} AS model_cod,
    {_fin("round(max(CASE WHEN stage = 'desk_review' THEN median END), 6)")} AS desk_review_ratio,
    {_fin("round(max(CASE WHEN stage = 'desk_review' THEN cod END), 6)")} AS desk_review_cod
  FROM dst GROUP BY township_name, price_decile),
dprices AS (
  SELECT township_name, price_decile, {_dollar('min(sale_price)')} || '-' || {_dollar('max(sale_price)')} AS price_range,
    count(*) AS number_of_sales
  FROM dec WHERE sale_price IS NOT NULL GROUP BY township_name, price_decile),
deciles AS (SELECT dwide.*, dprices.price_range, dprices.number_of_sales FROM dwide JOIN dprices USING (township_name, price_decile))"""

DECILES = RATIO_CTES + DECILES_BODY + "\nSELECT * FROM deciles\n"

CURVE_BODY = """
, curve AS (
  SELECT township_name, price_decile, 'Model Ratio' AS stage, model_ratio AS sale_ratio FROM deciles
  UNION ALL SELECT township_name, price_decile, 'Desk Review Ratio', desk_review_ratio FROM deciles),
curve2 AS (
  SELECT *, CAST(round(CAST(sale_ratio AS DECIMAL(20,6)), 2) AS DOUBLE) AS label,
    sale_ratio BETWEEN 0.9 AND 1.1 AS in_band FROM curve)"""

CURVE = RATIO_CTES + DECILES_BODY + CURVE_BODY + "\nSELECT * FROM curve2\n"

AXIS = RATIO_CTES + DECILES_BODY + CURVE_BODY + """
, bounds AS (SELECT township_name, least(coalesce(min(sale_ratio), 0.7), 0.7) AS y_min,
                    greatest(coalesce(max(sale_ratio), 1.3), 1.3) AS y_max FROM curve2 GROUP BY township_name)
SELECT township_name, y_min, y_max, t / 10.0 AS axis_break
FROM bounds, LATERAL (SELECT unnest(range(CAST(floor(y_min * 10) AS BIGINT), CAST(ceil(y_max * 10) AS BIGINT) + 1)) AS t)
"""

ALL_PARCELS = RATIO_CTES + """
SELECT township_name AS "Township Name", pin AS "Pin", desk_review_value AS "Desk Review Value",
  neighborhood_number AS "Neighborhood Number", model_value AS "Model Value", sale_price AS "Sale Price",
  sale_date AS "Sale Date", sale_document_number AS "Sale Document Number",
  model_sale_ratio AS "Model Sale Ratio", desk_review_sale_ratio AS "Desk Review Sale Ratio",
  price_decile AS "Price Decile"
FROM dec
"""

NBHD_BODY = """
, nb AS (
  SELECT township_name, neighborhood_number, 'model' AS stage, median(model_sale_ratio) AS m FROM dec GROUP BY ALL
  UNION ALL
  SELECT township_name, neighborhood_number, 'desk_review', median(desk_review_sale_ratio) FROM dec GROUP BY ALL),
nbl AS (
  SELECT township_name, neighborhood_number,
    CASE stage WHEN 'model' THEN 'Model' ELSE 'Desk Review' END AS stage,
    CASE stage WHEN 'model' THEN 1 ELSE 2 END AS stage_order,
    CASE WHEN isfinite(m) THEN round(m, 6) END AS median_sale_ratio
  FROM nb)"""

NBHD = RATIO_CTES + NBHD_BODY + "\nSELECT * FROM nbl\n"

NBHD_MAP = RATIO_CTES + NBHD_BODY + f"""
, box AS (
  SELECT township_name, replace(nbhd_code, '-', '') AS town_nbhd,
    min(lon) AS x0, min(lat) AS y0, max(lon) AS x1, max(lat) AS y1
  FROM uni WHERE lon IS NOT NULL AND NOT isnan(lon) AND lat IS NOT NULL GROUP BY township_name, replace(nbhd_code, '-', '')),
poly AS (
  SELECT township_name, town_nbhd,
    'POLYGON((' || {_numtext('x0')} || ' ' || {_numtext('y0')} || ', ' || {_numtext('x1')} || ' ' || {_numtext('y0')} || ', '
      || {_numtext('x1')} || ' ' || {_numtext('y1')} || ', ' || {_numtext('x0')} || ' ' || {_numtext('y1')} || ', '
      || {_numtext('x0')} || ' ' || {_numtext('y0')} || '))' AS geometry_wkt,
    -- big-endian, polygon, one ring of five points
    unhex('00' || '00000003' || '00000001' || '00000005' || {_bits('x0')} || {_bits('y0')} || {_bits('x1')} || {_bits('y0')}
      || {_bits('x1')} || {_bits('y1')} || {_bits('x0')} || {_bits('y1')} || {_bits('x0')} || {_bits('y0')}) AS geometry,
    4326 AS srid
  FROM box)
SELECT nbl.township_name, replace(nbl.neighborhood_number, '-', '') AS neighborhood_number, nbl.stage, nbl.stage_order,
  nbl.median_sale_ratio, poly.geometry, poly.geometry_wkt, poly.srid
FROM nbl LEFT JOIN poly ON nbl.township_name = poly.township_name AND replace(nbl.neighborhood_number, '-', '') = poly.town_nbhd
"""

STRICT_LENIENT = RATIO_CTES + """
, la AS (
  SELECT township_name, pin, sale_price, 'model' AS stage, model_sale_ratio AS ratio FROM dec
  UNION ALL SELECT township_name, pin, sale_price, 'desk_review', desk_review_sale_ratio FROM dec),
strict AS (
  SELECT stage, township_name, CASE WHEN count(ratio) = count(*) AND isfinite(median(ratio)) THEN round(median(ratio), 6) END AS strict_median,
    count(*) AS n_sales
  FROM la WHERE sale_price IS NOT NULL GROUP BY stage, township_name),
lenient AS (
  SELECT stage, township_name, CASE WHEN isfinite(median(ratio)) THEN round(median(ratio), 6) END AS lenient_median, count(*) AS n_parcels, count(ratio) AS n_ratios
  FROM la GROUP BY stage, township_name)
SELECT lenient.*, strict.strict_median, strict.n_sales FROM lenient LEFT JOIN strict USING (stage, township_name)
"""

NEWEST = _with(BASE) + """
SELECT pin, year, township_name, nbhd_code AS neighborhood_number FROM (
  SELECT *, row_number() OVER (PARTITION BY pin ORDER BY year DESC) AS rn FROM uni WHERE year IN ('1999', '2000'))
WHERE rn = 1
"""

COVERAGE = RATIO_CTES + "SELECT * FROM mv\n"

VALUE_CHANGE = _with(BASE, HIST, REQ) + f"""
, r2 AS (SELECT *, {_clean('"Permanent Index Number"')} AS pin FROM req),
vals AS (
  SELECT pin, class AS "Class", twoyr_pri_certified_tot AS "{MAIL_YEAR - 2} BoR Certified AV",
    oneyr_pri_certified_tot AS "{MAIL_YEAR - 1} BoR Certified AV", mailed_tot AS "{MAIL_YEAR} Mailed AV",
    CAST(mailed_tot - oneyr_pri_certified_tot AS DOUBLE) / nullif(CAST(oneyr_pri_certified_tot AS DOUBLE), 0) AS "Percent Change",
    mailed_tot > oneyr_pri_certified_tot * 1.2 AS "Large Increase"
  FROM hist WHERE year = '{MAIL_YEAR}')
SELECT r2."Permanent Index Number", r2."Owner Name", r2."class" AS "class x", r2.source_file, vals."Class" AS "Class y",
  vals."{MAIL_YEAR - 2} BoR Certified AV", vals."{MAIL_YEAR - 1} BoR Certified AV", vals."{MAIL_YEAR} Mailed AV",
  vals."Percent Change", vals."Large Increase"
FROM r2 LEFT JOIN vals USING (pin)
"""

CLEAN_KEYS = _with(BASE, REQ) + f"""
SELECT source_file, "Permanent Index Number" AS raw_key, {_clean('"Permanent Index Number"')} AS pin FROM req
"""

STACKED = _with(BASE, MODELS) + f"""
SELECT d.source_file, {_clean('d."PIN"')} AS pin, d."Desk Review Value" AS desk_review_value,
  CASE WHEN pb.triad_name IN ('AFRICA', 'ASIA') THEN 'desk-' || lower(pb.triad_name) END AS reviewer
FROM desk d JOIN pb ON d."PIN" = pb.pin
"""

UNMATCHED = _with(BASE, HIST, REQ) + f"""
SELECT source_file, {_clean('"Permanent Index Number"')} AS pin FROM req
WHERE {_clean('"Permanent Index Number"')} NOT IN (SELECT pin FROM hist WHERE year = '{MAIL_YEAR}')
"""

DOC_COUNTS = f"""
pc AS (SELECT pin, count(*) AS n_permits FROM permits WHERE assessment_year >= '{MIN_YEAR}' GROUP BY pin),
sc AS (SELECT pin, count(*) AS n_sales FROM sales WHERE year >= '{MIN_YEAR}' AND sv_is_outlier GROUP BY pin),
units AS (SELECT u.*, c.building_sf, c.unit_sf, c.bedrooms, c.full_baths, c.half_baths, c.parking_pin
          FROM uni u JOIN chars c ON u.pin = c.pin AND u.year = c.year)"""

JOIN_CHAIN = _with(BASE, CHARS, PERMITS, STATUS, SALES, ADDR, DOC_COUNTS) + """
SELECT u.pin, u.year, u.triad_name, u.township_name, u.building_sf, s.is_parking_space, a.prop_address_full,
  coalesce(pc.n_permits, 0) AS n_permits, coalesce(sc.n_sales, 0) AS n_sales
FROM units u
LEFT JOIN status s ON u.pin = s.pin AND u.year = s.year
LEFT JOIN addr a ON u.pin = a.pin AND u.year = a.year
LEFT JOIN pc ON u.pin = pc.pin
LEFT JOIN sc ON u.pin = sc.pin
"""

JOINED_ROWS = _with(BASE, CHARS, PERMITS, SALES) + f"""
, literal AS (
  SELECT u.pin10, COUNT(*) OVER (PARTITION BY u.pin10) AS total_number_of_units_in_building
  FROM uni u
  JOIN chars c ON u.pin = c.pin AND u.year = c.year
  LEFT JOIN permits p ON u.pin = p.pin AND p.assessment_year >= '{MIN_YEAR}'
  LEFT JOIN sales s ON u.pin = s.pin AND s.year >= '{MIN_YEAR}' AND s.sv_is_outlier)
SELECT DISTINCT pin10, total_number_of_units_in_building FROM literal
"""

UNIT_COUNT = _with(BASE, CHARS) + """
SELECT u.pin10, count(DISTINCT u.pin) AS total_number_of_units_in_building
FROM uni u JOIN chars c ON u.pin = c.pin AND u.year = c.year GROUP BY u.pin10
"""

FLAGGED = _with(BASE, QC) + """
SELECT DISTINCT pin, pin10 FROM uni WHERE pin10 IN (SELECT substr(pin, 1, 10) FROM flagged)
"""

SALE_ENTRY = ("CASE WHEN doc_no IS NOT NULL THEN '[' || doc_no || ', ' || strftime(sale_date, '%Y-%m-%d') || ', $' || "
              + _thousands("sale_price") + " || ']' END")
PERMIT_ENTRY = ("CASE WHEN permit_number IS NOT NULL THEN '[' || permit_number || ', ' || substr(date_issued, 1, 10) "
                "|| ', ' || work_description || ']' END")

SALE_TEXT = _with(BASE, SALES) + f"SELECT doc_no, pin, {SALE_ENTRY} AS sales FROM sales\n"

DOCS_BODY = f"""
sdoc AS (SELECT pin, string_agg(e, ', ' ORDER BY e) AS sales FROM (
           SELECT pin, {SALE_ENTRY} AS e FROM sales WHERE year >= '{MIN_YEAR}' AND sv_is_outlier) WHERE e IS NOT NULL GROUP BY pin),
pdoc AS (SELECT pin, string_agg(e, ', ' ORDER BY e) AS permits FROM (
           SELECT pin, {PERMIT_ENTRY} AS e FROM permits WHERE assessment_year >= '{MIN_YEAR}') WHERE e IS NOT NULL GROUP BY pin)"""

DOCS = _with(BASE, PERMITS, SALES, DOCS_BODY) + """
SELECT u.pin, sdoc.sales, pdoc.permits
FROM (SELECT DISTINCT pin FROM uni) u LEFT JOIN sdoc ON u.pin = sdoc.pin LEFT JOIN pdoc ON u.pin = pdoc.pin
"""

FIRST_ROW = _with(BASE, CHARS) + """
SELECT pin, year, triad_name, township_name, building_sf, unit_sf, bedrooms FROM (
  SELECT u.*, c.building_sf, c.unit_sf, c.bedrooms, row_number() OVER (PARTITION BY u.pin ORDER BY u.year DESC) AS rn
  FROM uni u JOIN chars c ON u.pin = c.pin AND u.year = c.year)
WHERE rn = 1
"""

ADDRESS_RAW = ("concat_ws(' ', a.prop_address_full, a.prop_address_city_name || ', IL', a.prop_address_zipcode_1)")
ALNUM = f"regexp_replace({ADDRESS_RAW}, '[^\\p{{L}}\\p{{Nd}}]', ' ', 'g')"
MAP_URL = "https://maps.example.org/?map=19.00/"


def _map_link(lon: str, lat: str, p10: str) -> str:
    return (f"'=HYPERLINK(\"{MAP_URL}' || {_numtext(lon)} || '/' || {_numtext(lat)} || '/0&pin10=' || {p10} "
            f"|| '\", \"' || {_pretty10(p10)} || '\")'")


def _search_link(addr: str) -> str:
    return f"'=HYPERLINK(\"https://www.google.com/search?q=' || {addr} || '\", \"' || {addr} || '\")'"


ADDRESS_LINKS = _with(BASE, ADDR) + f"""
, newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pin ORDER BY year DESC) AS rn FROM uni) WHERE rn = 1)
SELECT u.pin, {ADDRESS_RAW} AS address_raw, {ALNUM} AS address, {_search_link(ALNUM)} AS address_link,
  {_map_link('u.lon', 'u.lat', 'u.pin10')} AS map_link, {_pretty14('u.pin')} AS pin_pretty
FROM newest u LEFT JOIN addr a ON u.pin = a.pin AND u.year = a.year
"""

BLANKS = _with(BASE, ADDR) + """
SELECT nullif(pin, '') AS pin, nullif(year, '') AS year, nullif(prop_address_full, '') AS prop_address_full,
  nullif(prop_address_city_name, '') AS prop_address_city_name, nullif(prop_address_zipcode_1, '') AS prop_address_zipcode_1,
  nullif(prop_address_unit_number, '') AS prop_address_unit_number
FROM addr
"""

PLACEHOLDERS = _with(BASE, CHARS) + """
SELECT pin, year, building_sf, CAST(NULL AS VARCHAR) AS new_building_sf, unit_sf, CAST(NULL AS VARCHAR) AS new_unit_sf,
  bedrooms, CAST(NULL AS VARCHAR) AS new_bedrooms, full_baths, CAST(NULL AS VARCHAR) AS new_full_baths,
  half_baths, CAST(NULL AS VARCHAR) AS new_half_baths
FROM chars
"""

REVIEW_BODY = f"""
ubase AS (SELECT * FROM uni WHERE pin10 IN (SELECT substr(pin, 1, 10) FROM flagged)),
ujoin AS (
  SELECT * FROM (
    SELECT u.*, c.building_sf, c.unit_sf, c.bedrooms, c.full_baths, c.half_baths, c.parking_pin,
      row_number() OVER (PARTITION BY u.pin ORDER BY u.year DESC) AS rn
    FROM ubase u JOIN chars c ON u.pin = c.pin AND u.year = c.year) WHERE rn = 1),
ufull AS (
  SELECT u.*, s.is_parking_space, s.parking_space_flag_reason, s.is_common_area,
    a.prop_address_full, a.prop_address_city_name, a.prop_address_zipcode_1, a.prop_address_unit_number,
    sdoc.sales, pdoc.permits, count(*) OVER (PARTITION BY u.pin10) AS total_number_of_units_in_building
  FROM ujoin u
  LEFT JOIN status s ON u.pin = s.pin AND u.year = s.year
  LEFT JOIN addr a ON u.pin = a.pin AND u.year = a.year
  LEFT JOIN sdoc ON u.pin = sdoc.pin
  LEFT JOIN pdoc ON u.pin = pdoc.pin),
sheet AS (
  SELECT f.qc_flag AS "QC Flag", {_map_link('u.lon', 'u.lat', 'u.pin10')} AS "PIN10", {_pretty14('u.pin')} AS "PIN",
    {_search_link(ALNUM.replace('a.', 'u.'))} AS "Address", nullif(u.prop_address_unit_number, '') AS "Unit",
    u.total_number_of_units_in_building AS "Total Number Of Units In Building",
    u.building_sf AS "Building SF", CAST(NULL AS VARCHAR) AS "New Building SF",
    u.unit_sf AS "Unit SF", CAST(NULL AS VARCHAR) AS "New Unit SF",
    u.bedrooms AS "Bedrooms", CAST(NULL AS VARCHAR) AS "New Bedrooms",
    u.full_baths AS "Full Baths", CAST(NULL AS VARCHAR) AS "New Full Baths",
    u.half_baths AS "Half Baths", CAST(NULL AS VARCHAR) AS "New Half Baths",
    nullif(u.nbhd_code, '') AS "Neighborhood Code", u.permits AS "Permits", u.sales AS "Sales",
    nullif(u.parking_pin, '') AS "Parking PIN", u.is_parking_space AS "Is Parking Space",
    nullif(u.parking_space_flag_reason, '') AS "Parking Space Flag Reason", u.is_common_area AS "Is Common Area",
    u.triad_name AS "Triad", nullif(u.township_name, '') AS "Township"
  FROM ufull u LEFT JOIN flagged f ON u.pin = f.pin
  WHERE u.township_name IS NOT NULL)"""

REVIEW = _with(BASE, CHARS, PERMITS, STATUS, SALES, ADDR, QC, DOCS_BODY, REVIEW_BODY) + "SELECT * FROM sheet\n"

RULES = _with(BASE) + """
, ret AS (
  SELECT pin,
    CASE WHEN c_custkey % 7 = 0 THEN CAST(c_acctbal AS VARCHAR) END AS new_building_sf,
    CASE WHEN c_custkey % 11 = 0 THEN repeat('9', 45) WHEN c_custkey % 5 = 0 THEN CAST(c_custkey * 13 % 12001 AS VARCHAR) END AS new_unit_sf,
    CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 20 AS VARCHAR) WHEN c_custkey % 3 = 1 THEN '' END AS new_bedrooms,
    CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 3 AS VARCHAR) || '.5' END AS new_full_baths,
    CASE WHEN c_custkey % 6 = 0 THEN ' ' || CAST(c_custkey % 17 AS VARCHAR) || ' ' END AS new_half_baths
  FROM pb),
cells AS (
  SELECT pin, 'new_building_sf' AS "column", new_building_sf AS value, 0 AS lo, 10000000 AS hi FROM ret
  UNION ALL SELECT pin, 'new_unit_sf', new_unit_sf, 0, 10000 FROM ret
  UNION ALL SELECT pin, 'new_bedrooms', new_bedrooms, 0, 15 FROM ret
  UNION ALL SELECT pin, 'new_full_baths', new_full_baths, 0, 15 FROM ret
  UNION ALL SELECT pin, 'new_half_baths', new_half_baths, 0, 15 FROM ret),
judged AS (
  SELECT pin, "column", value,
    CASE WHEN value IS NULL OR trim(value) = '' THEN NULL
         WHEN NOT regexp_matches(trim(value), '^[+-]?[0-9]+$') THEN 'not whole'
         WHEN TRY_CAST(trim(value) AS DECIMAL(38,0)) BETWEEN lo AND hi THEN NULL ELSE 'out of range' END AS reason
  FROM cells)
SELECT pin, "column", value, reason FROM judged WHERE reason IS NOT NULL
"""

OUTPUT_COUNTS = REVIEW.replace("SELECT * FROM sheet\n", """SELECT "Triad", "Township", count(*) AS "rows" FROM sheet GROUP BY ALL
""")

INTAKE = _with(BASE, MODELS) + f"""
, intake AS (SELECT d.*, pb.c_custkey AS k, pb.triad_name AS t, pb.triad_name IN ('AFRICA', 'ASIA') AS one FROM desk d JOIN pb ON d."PIN" = pb.pin)
SELECT {_clean('"PIN"')} AS pin, "Desk Review Value" AS desk_review_value,
  CASE WHEN one THEN 'desk, ' || lower(t) END AS reviewer, CASE WHEN NOT one THEN 'x' END AS note,
  CASE WHEN one THEN CASE k % 3 WHEN 0 THEN 'said "high",' || chr(10) || 'then' || chr(10) || CAST(k AS VARCHAR) WHEN 1 THEN 'one line' END END AS comment,
  CASE WHEN one THEN CAST(k % 7 AS VARCHAR) END AS pin_2, CASE WHEN NOT one THEN CAST(k % 5 AS VARCHAR) END AS note_1,
  CASE WHEN NOT one THEN CAST(k % 11 AS VARCHAR) END AS note_3, CASE WHEN NOT one THEN CAST(k % 13 AS VARCHAR) END AS note_2
FROM intake
"""

#: What a spreadsheet reader makes of a column, cell by cell.
SHEET_TYPES = _with(BASE, MODELS) + """
, cells AS (
  SELECT d.source_file, unnest([
    {'column': 'PIN', 'cell': 'id'}, {'column': 'Desk Review Value', 'cell': CAST("Desk Review Value" AS VARCHAR)},
    {'column': 'Reviewed On', 'cell': CASE WHEN k % 4 <> 0 THEN CAST(DATE '2000-01-01' + CAST(k % 400 AS INTEGER) AS VARCHAR) END},
    {'column': 'Checked', 'cell': CASE k % 2 WHEN 0 THEN 'TRUE' ELSE 'false' END},
    {'column': 'Mixed', 'cell': CASE k % 97 WHEN 0 THEN 'n/a' ELSE CAST(k % 9 AS VARCHAR) END},
    {'column': 'Code', 'cell': lpad(CAST(k % 50 AS VARCHAR), 5, '0')}, {'column': 'Empty', 'cell': CAST(NULL AS VARCHAR)},
    {'column': 'Power', 'cell': CAST(k % 90 AS VARCHAR) || 'e2'}]) AS c
  FROM (SELECT desk.*, pb.c_custkey AS k FROM desk JOIN pb ON desk."PIN" = pb.pin) d),
kinds AS (
  SELECT source_file, c.column AS col, CASE
    WHEN lower(c.cell) IN ('true', 'false') THEN 'boolean'
    WHEN TRY_CAST(c.cell AS DOUBLE) IS NOT NULL AND NOT regexp_matches(c.cell, '^[+-]?0[0-9]|^[+-]?[0-9]{16}') THEN 'number'
    WHEN TRY_CAST(c.cell AS DATE) IS NOT NULL THEN 'date' ELSE 'text' END AS kind
  FROM cells WHERE c.cell IS NOT NULL)
SELECT a.source_file, a.col AS "column",
  CASE WHEN min(kind) = max(kind) THEN min(kind) WHEN min(kind) IS NULL THEN 'blank' ELSE 'text' END AS "type"
FROM (SELECT DISTINCT source_file, c.column AS col FROM cells) a LEFT JOIN kinds k ON a.source_file = k.source_file AND a.col = k.col
GROUP BY a.source_file, a.col
"""

SHEET_OUTPUTS = _with(BASE, HIST, REQ) + f"""
, named AS (SELECT r.*, pb.c_custkey AS k, pb.pin AS pin FROM req r JOIN pb ON r."Owner Name" = pb.c_name),
placed AS (
  SELECT *, 'requests ' || lpad(CAST(k // 1000 AS VARCHAR), 6, '0') || '.csv' AS sheet,
    row_number() OVER (PARTITION BY k // 1000 ORDER BY k * 7919 % 1009, encode("Permanent Index Number")) AS position FROM named)
SELECT sheet AS source_file, position, placed.pin AS pin, 'line' || chr(10) || "Owner Name" AS sent_by, hist.mailed_tot AS mailed,
  'Permanent Index Number|Sent By|Class|{MAIL_YEAR - 2} BoR Certified AV|{MAIL_YEAR - 1} BoR Certified AV|{MAIL_YEAR} Mailed AV|Percent Change|Large Increase' AS columns
FROM placed LEFT JOIN hist ON placed.pin = hist.pin AND hist.year = '{MAIL_YEAR}'
"""

REVIEW_COLUMNS = REVIEW.replace("SELECT * FROM sheet\n", """SELECT workbook, "Township", CAST(position AS INTEGER) AS position, names[position + 1] AS "column" FROM (
  SELECT DISTINCT replace(lower("Triad"), ' ', '_') || '_condo_review_2025' AS workbook, "Township" FROM sheet),
  (SELECT ['QC Flag', 'PIN10', 'PIN', 'Address', 'Unit', 'Total Number Of Units In Building', 'Building SF', 'New Building SF',
    'Unit SF', 'New Unit SF', 'Bedrooms', 'New Bedrooms', 'Full Baths', 'New Full Baths', 'Half Baths', 'New Half Baths',
    'Neighborhood Code', 'Permits', 'Sales', 'Parking PIN', 'Is Parking Space', 'Parking Space Flag Reason', 'Is Common Area'] AS names),
  (SELECT unnest(range(0, 23)) AS position)
""")

WORKBOOK = REVIEW.replace("SELECT * FROM sheet\n", """SELECT replace(lower("Triad"), ' ', '_') || '_condo_review_2025' AS workbook, "Township", "PIN",
  row_number() OVER (PARTITION BY "Triad", "Township" ORDER BY "PIN") AS position
FROM sheet WHERE "Township" <> (SELECT min("Township") FROM sheet)
""")

DECILE_SHEET = RATIO_CTES + DECILES_BODY + """
SELECT replace(township_name, ' ', '_') AS township_file, price_decile AS "Price Decile", number_of_sales AS "Number Of Sales",
  row_number() OVER (PARTITION BY township_name ORDER BY price_decile) AS position
FROM deciles
"""

PARAMETERISED = _with(BASE, SALES, QC) + f"""
SELECT s.pin, s.doc_no, s.sale_price AS price FROM sales s
WHERE s.year >= '{MIN_YEAR}' AND s.sv_is_outlier AND s.sale_price IS NOT NULL
  AND substr(s.pin, 1, 10) IN (SELECT substr(pin, 1, 10) FROM flagged)
"""

TOWNSHIPS = _with(BASE) + "SELECT DISTINCT triad_name, township_name FROM uni\n"

ORACLES: dict[str, str] = {
    "ratio_town_stats": TOWN_STATS,
    "ratio_deciles": DECILES,
    "ratio_all_parcels": ALL_PARCELS,
    "ratio_curve_long": CURVE,
    "ratio_curve_axis": AXIS,
    "neighborhood_medians_long": NBHD,
    "neighborhood_map_frame": NBHD_MAP,
    "strict_vs_lenient_median": STRICT_LENIENT,
    "newest_row_per_key": NEWEST,
    "coverage_explode_join": COVERAGE,
    "value_change_flags": VALUE_CHANGE,
    "clean_request_keys": CLEAN_KEYS,
    "stacked_requests": STACKED,
    "unmatched_requests": UNMATCHED,
    "condo_join_chain": JOIN_CHAIN,
    "building_joined_rows": JOINED_ROWS,
    "building_unit_count": UNIT_COUNT,
    "flagged_buildings": FLAGGED,
    "sale_document_text": SALE_TEXT,
    "documents_per_unit": DOCS,
    "first_row_per_unit": FIRST_ROW,
    "address_and_links": ADDRESS_LINKS,
    "blank_to_null": BLANKS,
    "placeholder_columns": PLACEHOLDERS,
    "unit_review_sheet": REVIEW,
    "range_rule_violations": RULES,
    "partitioned_output_counts": OUTPUT_COUNTS,
    "sheet_intake_roundtrip": INTAKE,
    "review_workbook_rows": WORKBOOK,
    "sheet_column_types": SHEET_TYPES,
    "request_sheet_outputs": SHEET_OUTPUTS,
    "review_sheet_columns": REVIEW_COLUMNS,
    "ratio_decile_sheet_rows": DECILE_SHEET,
    "parameterised_query": PARAMETERISED,
    "township_list": TOWNSHIPS,
}
