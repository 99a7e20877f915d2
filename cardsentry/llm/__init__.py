"""Training-data operators: each module is one operator, ``queries`` registers
the thin ``opN_*`` queries over the given tables.  Nothing outside this folder
imports it."""
