"""Reading and writing: files, day partitions, message streams, keyed tables.

External stores are given as ``(format, options)``; nothing here is tied to one product.
"""
