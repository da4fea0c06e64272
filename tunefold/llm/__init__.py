"""Operators of a training-data pipeline: decontamination, surrogates, classifiers, packing and the like."""
