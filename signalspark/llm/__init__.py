"""Training-data operators: dedup, quality, search, decontamination, packing, sharding, archives.

Nothing outside this subpackage imports it. Import the operator modules
directly; ``signalspark.llm.queries`` registers one query per operator.
"""
