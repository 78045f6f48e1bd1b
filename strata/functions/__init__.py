"""Column-expression functions: tag predicates, comment signal, geo."""
