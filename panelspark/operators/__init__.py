"""panelspark.operators: panel operators.

aggregates  generic features x functions in one groupBy
features    feature-family jobs (one groupBy each)
history     order-dependent windows, calendar completion
relational  projections, fills, clips, joins, set operations
sequences   panel -> fixed-length sequences, array operators, augmentation
encode      category encoders, character TF-IDF, SVD, scaling, auto-log
metrics     distributed running sums, ranking metric, ranks, AUC
folds       stratified folds, greedy class-balanced buckets
models      MLlib CV driver, stacking, imputation, tree-split capping
"""
