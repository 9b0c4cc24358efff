"""Analytics over records with user-defined fields, as plain Spark DataFrame plans.

Records are kept in two layouts: a long entity-attribute-value (EAV) table and
a denormalised document table. Both answer the same requests.
"""
