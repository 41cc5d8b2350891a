"""Column-expression builders. Everything here returns ``Column`` objects that
compile into Catalyst expressions (whole-stage codegen); no Python UDFs."""
