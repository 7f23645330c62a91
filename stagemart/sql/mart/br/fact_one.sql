-- One row per order line; what was paid is the price less the discount.
SELECT o.o_custkey AS id_dim_one,
       l.l_partkey AS id_dim_two,
       o.o_orderdate AS created_at,
       l.l_extendedprice AS sales_amount,
       l.l_extendedprice * (1 - l.l_discount) AS payment_amount
FROM datalake_lineitem l
JOIN datalake_orders o ON o.o_orderkey = l.l_orderkey
