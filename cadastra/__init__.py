"""Cadastra: territorial and housing-market analytics as lazy Spark plans."""
