-- Outlier sales of flagged buildings from a year on.
-- :min_year STRING
-- {sales} {flags}
SELECT s.pin, s.doc_no, s.sale_price AS price
FROM {sales} AS s
LEFT SEMI JOIN {flags} AS q ON substr(s.pin, 1, 10) = substr(q.pin, 1, 10)
WHERE s.year >= :min_year AND s.sv_is_outlier AND s.sale_price IS NOT NULL
