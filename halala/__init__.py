"""halala: multi-asset valuation on Spark, with every amount reported in Saudi riyal."""
