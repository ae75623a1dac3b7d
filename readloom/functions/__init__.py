"""Part of readloom; see the README."""
