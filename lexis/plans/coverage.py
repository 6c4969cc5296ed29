
COVERAGE = {
    "SRC-1": ["src_posts"], "SRC-2": ["split_quota_head", "split_batches"], "SRC-3": ["src_token_list", "packed_tokens"],
    "SRC-4": ["src_axis_slice"], "SRC-5": ["log_predictions", "log_predictions_target_first"],
    "SRC-6": ["log_epochs"], "SRC-7": ["log_train_loss", "bce_by_epoch"],
    "SNK-1": ["snk_csv_roundtrip", "src_posts"], "SNK-2": ["confusion_wide", "snk_matrix_csv"],
    "SNK-3": ["snk_report", "snk_report_matrix"], "SNK-4": ["stream_score", "score_record"],
    "TXT-1": ["txt_url_ws"], "TXT-2": ["txt_eos_tokens"], "TXT-3": ["txt_punct"], "TXT-4a": ["txt_letters"],
    "TXT-4b": ["txt_letters_space", "txt_letters_space_ws"], "TXT-5": ["txt_lower"],
    "TXT-6": ["txt_triple_truncate"], "TXT-7a": ["txt_drop_short"], "TXT-7b": ["txt_drop_long"],
    "TXT-8a": ["txt_ws_collapse"], "TXT-8b": ["txt_spaces_collapse"], "TXT-9": ["txt_url_mask"],
    "TXT-10": ["txt_url_star"], "TXT-11": ["txt_digit_mask"], "TXT-12": ["txt_squeeze"],
    "TXT-13": ["txt_drop_ellipsis"], "TXT-14a": ["txt_label_strip"], "TXT-14b": ["txt_label_star"],
    "TXT-14c": ["txt_label_mask"], "TXT-14d": ["clean_profile"], "TXT-15": ["txt_star_mask"],
    "TXT-16a": ["txt_trim_ends"], "TXT-16b": ["txt_trim_quoted"], "TXT-16c": ["txt_trim_quotes"],
    "TXT-17": ["txt_close_sentence"], "TXT-18": ["txt_any_triple_truncate"], "TXT-19": ["txt_mask_density"],
    "TXT-20": ["txt_separators", "txt_separators_drop"], "TXT-21": ["clean_light"],
    "TXT-22": ["txt_stopwords", "stopwords_anti_join"], "TXT-23": ["txt_lemma_join"],
    "TXT-24a": ["txt_word_count"], "TXT-24b": ["txt_word_count"], "TXT-24c": ["txt_word_count"],
    "CLN-1": ["clean_profile", "clean_profile_docs", "hist_before_after", "hist_before_after_text"],
    "CLN-2": ["clean_bow", "txt_lemma_join"], "CLN-3": ["clean_light"], "CLN-4": ["clean_mask_lower"],
    "CLN-5": ["clean_mask_post"], "CLN-6": ["clean_request"], "CLN-7": ["clean_long"],
    "GEN-1": ["posts_explode"], "GEN-2": ["tokens_explode"], "GEN-3": ["sentences_filtered"],
    "GEN-4": ["sentences_request"], "GEN-5": ["chunk_labels"],
    "FLT-1": ["min_words_filter"], "FLT-2": ["sentences_filtered"], "FLT-3": ["usable_posts", "clean_mask_post"],
    "FLT-4": ["pack_request"], "FLT-5": ["log_predictions"],
    "PCK-1": ["pack_by_class", "packed_tokens"], "PCK-2": ["pack_by_person"], "PCK-3": ["pack_request"],
    "PAD-1": ["pad_truncate"], "PAD-2": ["pack_request"], "PAD-3": ["batch_number"], "MSK-1": ["attention_mask"],
    "TOK-1": ["vocab_encode"], "TOK-2": ["vocab_decode"], "TOK-3": ["vocab_encode"],
    "SPL-1": ["split_stratified"], "SPL-2": ["split_quota_head"], "SPL-3": ["split_batches"],
    "SPL-4": ["split_overlap", "split_disjoint"], "SPL-5": ["bootstrap_exact"], "SPL-6": ["split_positional"],
    "ORD-1": ["shuffle_seeded"], "ORD-2": ["head_tail"], "ORD-3": ["sort_by_length"],
    "TOP-1": ["vocab_topk"], "TOP-2": ["knn_topk"], "ARG-1": ["argmax_class"], "SEQ-1": ["log_train_loss"],
    "LBL-1": ["label_bits"], "LBL-2": ["label_code"], "LBL-3": ["label_code"],
    "LBL-4": ["label_alpha", "label_indexer"], "LBL-5": ["label_decode"], "LBL-6": ["label_decode"],
    "LBL-7": ["label_flip"], "LBL-8": ["label_flip"], "LBL-9": ["label_onehot"],
    "LBL-10": ["score_to_label", "score_requests"], "LBL-11": ["score_to_label", "score_requests", "score_record"],
    "AGG-1": ["count_by_type", "count_by_type_docs"], "AGG-2": ["distinct_types"],
    "AGG-3": ["table_shape", "count_matrix_shape"], "AGG-4": ["hist_person", "hist_post", "hist_docs"],
    "AGG-5": ["hist_before_after"], "AGG-6": ["axis_counts"], "AGG-7": ["split_quota_head"],
    "AGG-8": ["term_stats"],
    "EVL-1": ["confusion_long", "confusion_knn"], "EVL-2": ["confusion_actual_rows", "log_recombine"],
    "EVL-3": ["confusion_soft", "model_mlp_16"], "EVL-4": ["axis_f1", "log_axis_f1"], "EVL-5": ["axis_f1"],
    "EVL-6": ["macro_f1"], "EVL-7": ["accuracy", "accuracy_knn", "model_axes"], "EVL-8": ["bce_by_epoch"],
    "EVL-9": ["log_train_loss"], "EVL-10": ["axis_recombine", "log_recombine"],
    "SCR-1": ["score_chunks", "score_requests"],
    "FEA-1": ["count_vectors", "count_matrix_shape"], "FEA-2": ["vocab_df_limited"], "FEA-3": ["tfidf_l2"],
    "FEA-4": ["tfidf_vectors"], "FEA-5": ["ngram_features"],
    "MOD-1": ["model_rf", "model_split"], "MOD-2": ["model_gbt"], "MOD-3": ["model_linear_svc"], "MOD-4": ["model_logreg"],
    "MOD-5": ["knn_predict"], "MOD-6": ["model_rff_svm"], "MOD-7": ["model_axes", "model_axes_matrix"], "MOD-8": ["model_mlp_axis"],
    "MOD-9": ["model_mlp_16"], "MOD-10": ["batch_score", "score_requests_model"], "MOD-11": ["batch_score", "score_requests_model"],
    "JN-1": ["label_bits"], "JN-2": ["label_dim_join"], "JN-3": ["stopwords_anti_join"],
    "JN-4": ["confusion_long"], "JN-5": ["log_recombine"], "JN-6": ["knn_topk"],
    "JN-7": ["vocab_encode", "tfidf_l2"],
    "SET-1": ["split_overlap"], "SET-2": ["split_quota_head"], "SET-3": ["log_predictions"],
    "STR-1": ["stream_score", "score_requests", "stream_score_model"],
}
