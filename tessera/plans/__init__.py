"""The 20 medallion models as DataFrame functions, plus the layer builder."""
