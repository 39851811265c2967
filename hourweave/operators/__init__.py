"""Operators on hourly panels; each module covers one block of the operator inventory:

lookback (partitioning for look-back windows), preprocess (P), windows (W1-W12, W17),
wide (W13-W16), forecast (F1-F7, F13), ensemble (F8-F11), evaluate (E), audit (A),
quality (V), submission (F12, S12).
"""
