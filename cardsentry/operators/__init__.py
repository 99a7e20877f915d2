"""DataFrame → DataFrame operators: chain join, SCD2, point-in-time join,
card sequences and the fraud rules."""
