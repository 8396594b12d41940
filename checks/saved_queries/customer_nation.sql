SELECT c.c_custkey, c.c_acctbal, n.n_name
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_acctbal > 0;
