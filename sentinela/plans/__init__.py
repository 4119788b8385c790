"""Marts, reports and the batch load, composed from functions and operators."""
