"""Training-data operators: token counts, language id, top-k search, packing, token files,
benchmark decontamination, quality, line and near-duplicate removal, licence scans.

Nothing else in the library imports this subpackage.
"""
