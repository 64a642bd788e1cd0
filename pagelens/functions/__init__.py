"""Scalar functions: columns in, columns out. Built-in expressions throughout; one Arrow layer in `html` where markup has to be parsed."""
