"""Single steps: each takes DataFrames and returns a DataFrame.

Steps that join a model table (coefficients, profiles) measure it first; everything else
is lazy.
"""
