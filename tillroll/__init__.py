"""tillroll — a Spark-native retail sales analytics engine.

Five raw tables (customers, products, orders, order items, transactions)
are cleaned with deterministic rules and turned into six analytical
reports, all as DataFrame plans that Catalyst and AQE optimise.
"""

__version__ = "0.1.0"
