"""Training-data operators: dedup, decontamination, classifiers, secrets,
fingerprints, chat formatting and BPE over document tables.

Every module holds one operator with a general interface (column names,
thresholds and vocabularies are parameters); :mod:`.queries` applies them to
the given tables.  Nothing outside this subpackage imports it.
"""
