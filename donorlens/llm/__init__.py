"""Training-data operators: near-duplicates, tokenising, exact copies, URL filters, toxicity, quality rules,
source mixing, licence scans, sharding and a quality classifier. Nothing else in the library imports this package.
"""
