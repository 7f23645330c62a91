-- Customers with their nation and region. The data holds no age.
SELECT c.c_custkey AS id,
       c.c_name AS username,
       CAST(NULL AS INT) AS age,
       n.n_name AS company,
       r.r_name AS address
FROM datalake_customer c
JOIN datalake_nation n ON n.n_nationkey = c.c_nationkey
JOIN datalake_region r ON r.r_regionkey = n.n_regionkey
