"""Training-data operators: fingerprints, WARC, toxicity, sharding, similarity
join, quality, decontamination, packing, language id, LM scoring, license
scans, spelling variants and conversation tries.

Nothing outside this package imports it (the driver contract file adds its
queries when it is present).
"""
