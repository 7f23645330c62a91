-- Parts with the last day one of them was shipped, NULL if none ever was.
SELECT p.p_partkey AS id,
       p.p_name AS item_name,
       p.p_brand AS brand,
       CAST(p.p_size AS DOUBLE) AS item_box_amount,
       s.valid_until
FROM datalake_part p
LEFT JOIN (
    SELECT l_partkey, max(l_shipdate) AS valid_until
    FROM datalake_lineitem
    GROUP BY l_partkey
) s ON s.l_partkey = p.p_partkey
