"""Operators for preparing language-model training data.

Every operator takes and returns DataFrames and names its text and id columns as arguments. Some
add columns and leave the others alone; those that return rows of their own say so. Nothing outside
this folder imports it.
"""
