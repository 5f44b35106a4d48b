"""Classifiers: Spark ML estimators and the ones Spark lacks, behind one registry."""
